"""Keyed state of streams: the newest version per key (K1, K2, R4) and first-seen rows within a watermark.

Two forms of the first, both streaming aggregates that run in the JVM: the state (RocksDB) holds the newest row of each
key, and a partial step per task reduces a key that holds a third of a micro-batch before the shuffle. ``newest_rows``
emits every key that a micro-batch touches. ``newest_versions`` emits what changes the table and nothing else: each row
carries the time of its micro-batch, of equal versions the earlier one stays, and a key's row leaves only if it came
with this micro-batch. So a message that arrives again, in another file or after a restart, is no change.

With ``hold_rows=False`` the state of ``newest_versions`` holds versions (``seq``, then a second column) instead of rows,
by a ``StatefulProcessor``: smaller state, at the price of Python work for each cell of each row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COMPRESSION = "spark.sql.streaming.stateStore.rocksdb.compression"
PARTITIONS = "spark.sql.shuffle.partitions"


def start_keyed(spark: SparkSession, start, partitions: int | None = None):
    """``start()`` of a stream with keyed state: the store is RocksDB with zstd (rows hold texts), and the
    state has ``partitions`` parts (fixed at the first start; default: the session's shuffle partitions). The session is
    left as it was."""
    wanted = {PROVIDER: ROCKS_DB, COMPRESSION: "zstd"} | ({PARTITIONS: str(partitions)} if partitions else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        return start()                               # the query copies the session's settings
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class NewestVersion(StatefulProcessor):
    """Lets the best row of a key pass if its version is greater than the stored one."""

    def __init__(self, seq: str, then: str):
        self.seq, self.then = seq, then

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.version = handle.getValueState("version", T.StructType([
            T.StructField("seq", T.LongType()), T.StructField("then", T.StringType())]))

    @staticmethod
    def _order(seq, then) -> tuple:                  # nulls first
        return seq is not None, seq or 0, then is not None, then or ""

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        best = max(rows, key=lambda r: self._order(r[self.seq], r[self.then]))
        old = self.version.get()
        if old is None or self._order(*old) < self._order(best[self.seq], best[self.then]):
            self.version.update((best[self.seq], best[self.then]))
            yield best

    def close(self) -> None:
        pass


def _best_of_batch(keys: list[str], seq: str, then: str):
    """Of each Arrow batch the best row per key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows > 1:
                column = lambda n: batch.column(batch.schema.get_field_index(n))
                code = np.zeros(batch.num_rows, np.int64)
                for k in keys:
                    values = column(k).dictionary_encode(null_encoding="encode")
                    code = code * len(values.dictionary) + values.indices.to_numpy(zero_copy_only=False)
                table = pa.table({"k": code, "s": column(seq), "t": column(then), "i": np.arange(batch.num_rows)})
                order = pc.sort_indices(table, sort_keys=[("k", "ascending"), ("s", "descending"), ("t", "descending")],
                                        null_placement="at_end").to_numpy()
                first = order[np.append(True, code[order][1:] != code[order][:-1])]
                batch = batch.take(pa.array(np.sort(first)))
            yield batch
    return run


def newest_rows(rows: DataFrame, keys: list[str], seq: str, then: str) -> DataFrame:
    """The newest row, by (``seq``, ``then``), of each key that a micro-batch of a stream touches. Start the query by
    ``start_keyed``, in update mode."""
    others = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(seq, then)).alias("_r"))
    return best.select(*[c if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def newest_versions(rows: DataFrame, keys: list[str], seq: str, then: str, hold_rows: bool = True) -> DataFrame:
    """The rows of a stream that change a keyed table: per key and micro-batch the one with the greatest
    (``seq``, ``then``), if that is greater than all before. Start the query by ``start_keyed``, in update mode."""
    if not hold_rows:
        reduced = rows.mapInArrow(_best_of_batch(keys, seq, then), rows.schema)
        return reduced.groupBy(*keys).transformWithState(NewestVersion(seq, then), rows.schema, "Update", "None")
    others = [c for c in rows.columns if c not in keys]
    now = F.unix_millis(F.current_timestamp())       # in a stream the time of the micro-batch, also when it is replayed
    best = rows.withColumn("_at", now).groupBy(*keys).agg(
        F.max_by(F.struct(*others, "_at"), F.struct(seq, then, -F.col("_at"))).alias("_r"))
    # should a clock ever give two micro-batches one time, or go back, an equal version may leave again, but none is lost
    return best.where(F.col("_r._at") == now).select(*[c if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def first_within(rows: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key in a stream; its repeats are dropped as long as the key's time is less than
    ``delay`` behind the greatest time seen. Rows more than ``delay`` behind that mark, as it was before their
    micro-batch, are late and dropped; keys that far behind are forgotten, so state is as large as a ``delay`` of keys."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
