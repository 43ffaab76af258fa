"""Positions and running sums within groups, without putting a group into one task.

``row_number()`` / running ``sum()`` over ``Window.partitionBy(group)`` sorts each group inside one
task, so a group holding a third of all rows becomes one straggler. Here instead:

1. range-partition on (group, order) and sort within partitions: a hot group is spread over many
   consecutive partitions, each holding a sorted run (as many partitions as shuffles have, fewer for a small table);
2. per partition, each row's position inside its run comes from ``monotonically_increasing_id()``
   evaluated right after the sort (its low 33 bits count rows within the partition); running sums,
   when asked for, come from a vectorised pandas pass (Arrow batches, numpy cumsum);
3. per (partition, group) totals form a table of at most partitions + groups rows; cumulative
   offsets over it (tiny window) are joined back.

The key columns are first written as a table in the shared folder (so the range-bound sampling
pass reads a narrow table, not the whole input again), and step 2's output is written too, so both
consumers of it see the same rows (range bounds come from sampling and must not be recomputed
differently).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstream.session import materialize

INDEX_ROWS = 1 << 15            # rows for which a further partition is worth a task


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``); one copy of each key column kept.
    A plain join on a NULL group key would silently drop those rows."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("right", "right_outer"):
        out = out.drop(*keys)
        for k in keys:
            out = out.withColumnRenamed(f"_r_{k}", k)
        return out
    return out.drop(*[f"_r_{k}" for k in keys])


def _local_runs(group_cols: list[str]):
    """Per Spark partition (rows sorted by group): position and running sum of ``_val`` inside each run of
    equal group keys, carried across Arrow batches of the same partition. A null key equals only null."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_key, carry_pos, carry_sum = None, 0, 0
        for pdf in batches:
            n, vals = len(pdf), pdf["_val"].to_numpy()
            if n == 0:
                yield pdf.drop(columns="_val").assign(_lpos=np.zeros(0, dtype=np.int64), _lcum=vals)
                continue
            change = np.zeros(n, bool)
            change[0] = True
            for c in group_cols:
                null, col = pdf[c].isna().to_numpy(), pdf[c]
                differs = (col != col.shift()).to_numpy() & ~(null & np.append(False, null[:-1]))
                change[1:] |= differs[1:]
            run = change.cumsum()
            lpos = pd.Series(np.ones(n, dtype=np.int64)).groupby(run).cumsum().to_numpy() - 1
            lcum = pd.Series(vals).groupby(run).cumsum().to_numpy() - vals
            keys = [[None if pd.isna(v) else v for v in pdf[group_cols].iloc[i]] for i in (0, -1)]
            if last_key == keys[0]:
                m = run == run[0]
                lpos[m] += carry_pos
                lcum[m] += carry_sum
            last_key, carry_pos, carry_sum = keys[1], int(lpos[-1]) + 1, lcum[-1] + vals[-1]
            yield pdf.drop(columns="_val").assign(_lpos=lpos, _lcum=lcum)
    return fn


def index_within(df: DataFrame, group_cols: list[str], order_cols: list[str], value_col: str | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Adds ``idx`` (0-based position inside the group by ``order_cols``) and, with ``value_col``,
    ``cum_before`` (sum of ``value_col`` over the earlier rows of the group, nulls as 0; a bigint for whole numbers).

    ``order_cols`` must make the order total (end with a unique key)."""
    spark = df.sparkSession
    keys = [*group_cols, *order_cols]
    payload = [c for c in df.columns if c not in keys]
    # Only the key columns travel through the sort, Python and the checkpoint; the payload is
    # joined back at the end on (group, order), which is unique.
    cols = [*keys, value_col] if value_col else keys
    narrow = materialize(df.select(*cols), "index-keys")
    n = num_partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")), narrow.count() // INDEX_ROWS + 1)
    s = narrow.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_pid", F.spark_partition_id())
    if value_col:
        kind = T.LongType() if isinstance(narrow.schema[value_col].dataType, T.IntegralType) else T.DoubleType()
        out_schema = T.StructType(s.schema.fields + [T.StructField("_lpos", T.LongType()), T.StructField("_lcum", kind)])
        s = s.withColumn("_val", F.coalesce(F.col(value_col).cast(kind), F.lit(0).cast(kind)))
        local = materialize(s.mapInPandas(_local_runs(group_cols), out_schema), "index-runs")
    else:
        row_in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        local = materialize(s.withColumn("_row", row_in_part), "index-runs")
        first = local.groupBy("_pid", *group_cols).agg(F.min("_row").alias("_first"))
        local = join_null_safe(local, first, ["_pid", *group_cols]).select(
            *cols, "_pid", (F.col("_row") - F.col("_first")).alias("_lpos"), F.lit(0.0).alias("_lcum"))
    tot = local.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_n"),
                                                 F.coalesce(F.sum(value_col if value_col else F.lit(0)), F.lit(0)).alias("_v"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_pid", *group_cols, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off_n"),
                     F.coalesce(F.sum("_v").over(w), F.lit(0)).alias("_off_v"))
    j = join_null_safe(local, off, ["_pid", *group_cols])
    j = j.withColumn("idx", (F.col("_off_n") + F.col("_lpos")).cast("bigint"))
    if value_col:
        j = j.withColumn("cum_before", F.col("_off_v") + F.col("_lcum"))
    j = j.drop("_pid", "_lpos", "_lcum", "_off_n", "_off_v")
    rest = [c for c in payload if c != value_col]
    if not rest:
        return j
    return join_null_safe(j, df.select(*keys, *rest), keys)
