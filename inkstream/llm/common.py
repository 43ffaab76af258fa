"""Helpers shared by the operators: row streaming out of Arrow batches, output building, names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from inkstream.session import fresh_path, materialize  # noqa: F401  (used by the operators)


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of a string column, one at a time; null gives ``b""``."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for v in column.cast(kind):
        yield v.as_py() or b""


def str_texts(column: pa.Array) -> Iterator[str]:
    """Each text of a string column, one at a time; null gives ``""``."""
    for v in column:
        yield v.as_py() or ""


def batch_of(schema: T.StructType, columns: list) -> pa.RecordBatch:
    """A record batch with the Arrow types Spark expects for ``schema``; columns are Python lists,
    numpy arrays or Arrow arrays."""
    arrow = to_arrow_schema(schema, prefers_large_types=False)
    arrays = [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
              for c, f in zip(columns, arrow)]
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def schema_of(df: DataFrame, id_col: str, *more: tuple[str, T.DataType]) -> T.StructType:
    """``id_col`` with its type in ``df``, then the named fields."""
    return T.StructType([T.StructField(id_col, df.schema[id_col].dataType)]
                        + [T.StructField(n, t) for n, t in more])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with a suffix when ``df`` already has a column of that name."""
    return base if base not in df.columns else f"{base}_{uuid.uuid4().hex[:8]}"


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def hashed_sample(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of a table without repeated ``keys``: those with the smallest hash of the keys (ties by
    the keys). Group repeated rows first and carry their number along. Rows far over the expected bound are
    filtered out first, so that tasks send on little more than the sample."""
    n, span = rows.count(), 1 << 40
    h = F.pmod(F.xxhash64(*keys), F.lit(span))
    if n > most:
        rows = rows.where(h < int(min(1.0, 1.3 * most / n + 100 / n) * span))
    return rows.orderBy(h, *keys).limit(most)


def with_new_text(docs: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``n_chars`` (where the table has it) set to the length of the text as it is now."""
    if n_chars_col not in docs.columns:
        return docs
    kind = docs.schema[n_chars_col].dataType
    return docs.withColumn(n_chars_col, F.char_length(text_col).cast(kind))


def dealt_cells(rows: DataFrame, keys: list[str], held: int, asked: int, by: Column) -> DataFrame:
    """Rows of cells (``keys``), members (``asks`` false) and queries (true), laid out for ``cell_runs``:
    cells with over ``held`` members are cut into blocks that all their queries meet, and cells with over
    ``asked`` queries into turns that all their members attend; ``by`` is the hash that deals rows. Inside a
    partition rows come by cell, block and turn, members first. The plan has one entry a cell."""
    plan = rows.groupBy(*keys).agg(F.ceil(F.count_if(~F.col("asks")) / held).cast("int").alias("blocks"),
                                   F.ceil(F.count_if("asks") / asked).cast("int").alias("turns"))
    count = {n: F.greatest(F.col(n), F.lit(1)) for n in ("blocks", "turns")}
    every = {n: F.sequence(F.lit(0), c - 1) for n, c in count.items()}
    one = {n: F.array(F.pmod(by, c).cast("int")) for n, c in count.items()}
    order = [*keys, "block", "turn"]
    placed = (rows.join(F.broadcast(plan), keys)
              .withColumn("block", F.explode(F.when(F.col("asks"), every["blocks"]).otherwise(one["blocks"])))
              .withColumn("turn", F.explode(F.when(F.col("asks"), one["turns"]).otherwise(every["turns"]))))
    return (placed.select(*order, *[c for c in rows.columns if c not in keys])
            .repartition(*order).sortWithinPartitions(*order, "asks"))


def cell_runs(batches, n_keys: int) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """(cell, asks, rows) of each run of equal ``n_keys`` first columns and ``asks``, which follows them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys + 1)]
        starts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist()]
        for s, e in zip(starts, [*starts[1:], batch.num_rows]):
            yield tuple(int(c[s]) for c in columns[:n_keys]), bool(columns[-1][s]), batch.slice(s, e - s)
