"""Keyed tables with last-write-wins (K1, K2, K3, K8, K12, U2) as plain Parquet.

A table is a folder of batches, ``<path>/b=<batch id>``, each a plain Parquet write. A batch is already reduced
to one row per key and written with ``mode=overwrite``, so a replayed batch changes nothing. A reader takes, per
key, the row with the greatest ``seq`` over all batches: ``groupBy(key).agg(max_by(struct(row), seq))``, an
aggregate with a partial (map-side) step, so a key holding a third of all versions is reduced on every map task
before the shuffle. Its buffer holds a whole row, so Spark plans it with sorting, which spills.

Streams write only what their keyed state says is new (``streaming.state``), so a table grows with its changes.
``compact`` is an ordinary job that writes the live rows as the first batch of another folder of the caller's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstream.operators.indexing import join_null_safe
from inkstream.session import materialize


def latest_per_key(df: DataFrame, key: str | list[str], seq: str | tuple[str, ...]) -> DataFrame:
    """One row per key: the row with the greatest seq (or tuple of columns, compared in order);
    partial-aggregation friendly."""
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    order = F.col(seq) if isinstance(seq, str) else F.struct(*seq)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def upsert(path: str, batch: DataFrame, key: str | list[str], seq: str | tuple[str, ...], batch_id: int) -> None:
    """K1/K2: put ``batch`` into the table (last write wins by ``seq``). An id used before is replaced."""
    latest_per_key(batch, key, seq).write.mode("overwrite").parquet(f"{path}/b={batch_id}")


def read_keyed(spark: SparkSession, path: str, key: str | list[str], seq: str | tuple[str, ...]) -> DataFrame:
    """The live table: one row per key over all batches."""
    return latest_per_key(spark.read.parquet(path).drop("b"), key, seq)


def compact(spark: SparkSession, path: str, into: str, key: str | list[str], seq: str | tuple[str, ...]) -> None:
    """Write the live rows of the table at ``path`` as the first batch of a new table ``into``."""
    read_keyed(spark, path, key, seq).write.parquet(f"{into}/b=0")


def get_or_create(existing: DataFrame, requests: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """K8 in batch form: for each distinct request key, the existing id (the least one when the table
    holds several) or a new deterministic id (md5 of the key parts, each with its length, so that
    different keys never share one); ``created`` tells which. NULL key parts match NULL (the lookup is
    by value, as a document filter would be)."""
    have = existing.groupBy(*keys).agg(F.min(id_col).alias("_old"))
    req = requests.select(*keys).distinct()
    parts = [F.col(k).cast("string") for k in keys]
    new_id = F.md5(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]))
    out = join_null_safe(req, have, keys, "left")
    return out.select(*keys, F.coalesce("_old", new_id).alias(id_col), F.col("_old").isNull().alias("created"))


def get_or_create_rows(spark: SparkSession, path: str, requests: DataFrame, keys: list[str],
                       id_col: str = "id") -> DataFrame:
    """K8: ``get_or_create`` against the table at ``path``; the created rows are appended to it."""
    out = materialize(get_or_create(spark.read.parquet(path), requests, keys, id_col), "get-or-create")
    out.where("created").select(*keys, id_col).write.mode("append").parquet(path)
    return out
