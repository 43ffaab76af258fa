"""Structured Streaming flows (S1, S2, S3, S14, R1..R6, K3, K5, K6).

Change capture (R5):  change envelopes (file stream) -> inserts only -> flatten -> JSON queue files.
Feature flow   (R1):  queue files -> dispatch + validate -> clean -> one row for the cleaned article and one per
                      chunk -> keyed state (newest version per table and key) -> foreachBatch {
                          changes of the cleaned table (K1); embed, changes of the vector table (K2) }
Quarantine     (R6):  queue files -> refused lines with the reason.

Every query has a checkpoint under the shared folder: offsets, commits and state make a restart resume
where it stopped (R4). Messages that arrive again are no change for the state; a replayed micro-batch rewrites
the same folders (keyed by batch id). The queue is a folder of JSON files (any number of files, read in
parallel; ``maxFilesPerTrigger`` bounds a micro-batch).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstream.functions.text import clean_text
from inkstream.operators import records as R
from inkstream.operators import tables as K
from inkstream.operators.chunking import chunk_text
from inkstream.operators.embedding import hash_embed
from inkstream.streaming.state import newest_rows, newest_versions, start_keyed

MESSAGE_SCHEMA = ("seq bigint, type string, entry_id string, source string, title string, summary string, "
                  "content string, published_at string")
ENVELOPE_SCHEMA = ("seq bigint, operationType string, ns struct<coll:string>, fullDocument struct<_id:string,"
                   "source:string,title:string,content:string,summary:string,published_at:string>")


def publish_messages(df: DataFrame, queue_dir: str, files: int | None = None) -> None:
    """S14/K6 (batch form): rows -> JSON messages appended to the queue folder as new files (one per
    partition of ``df``, or ``files``)."""
    (df.repartition(files) if files else df).write.mode("append").json(queue_dir)


def parse_messages(lines: DataFrame) -> DataFrame:
    """Lines (``value``) -> message fields, the line as it came (``raw``) and whether it is broken."""
    msg = F.from_json("value", MESSAGE_SCHEMA + ", _broken string", {"columnNameOfCorruptRecord": "_broken"})
    return lines.select(F.col("value").alias("raw"), msg.alias("m")).select(
        "m.*", "raw", (F.col("m").isNull() | F.col("m._broken").isNotNull()).alias("broken")).drop("_broken")


def queue_source(spark: SparkSession, queue_dir: str, max_files_per_trigger: int = 64) -> DataFrame:
    """The queue as a stream of decoded messages (explicit schema, bounded micro-batches)."""
    return parse_messages(spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(queue_dir))


def change_capture(spark: SparkSession, envelope_dir: str, queue_dir: str, checkpoint: str,
                   max_files_per_trigger: int = 64, trigger: dict | None = None):
    """Envelopes -> inserts -> flat message (entry_id, type = collection) -> queue.
    ``trigger``: arguments of Spark's ``trigger`` (default: all that is there, then stop)."""
    env = spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(envelope_dir)
    msgs = R.flatten_change(R.insert_only(env), keep=("seq",))
    msgs = msgs.select("seq", "type", "entry_id", "source", "title", "summary", "content", "published_at")
    # A plain folder of JSON files (no file-sink log), so any producer can append messages to it.
    # A replayed micro-batch appends its messages again: at-least-once, absorbed by the keyed upserts.
    return (msgs.writeStream.foreachBatch(lambda df, _id: df.write.mode("append").json(queue_dir))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def checked_messages(batch: DataFrame, as_of: str) -> DataFrame:
    """Messages with the reason why a row is refused (null: accepted); a missing date
    becomes ``as_of``."""
    checked = R.validate(R.dispatch(batch).withColumnRenamed("reason", "type_reason"), as_of=as_of)
    reason = F.when(F.col("broken"), F.lit("broken message")).otherwise(F.coalesce("type_reason", "reason"))
    return checked.withColumn("reason", reason).drop("type_reason")


def cleaned_messages(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).select(
        "entry_id", "seq", "source", "title", clean_text("content").alias("cleaned_content"), "summary", "published_at",
        F.lit(R.CLEANED_TYPE).alias("type"))


#: Order of versions: later messages win; the id decides only between equal ones.
CLEANED_ORDER, VECTOR_ORDER = "seq", ("seq", "entry_id")


CLEANED, VECTORS = "cleaned_articles", "vector_articles"


def keyed_rows(cleaned: DataFrame) -> DataFrame:
    """For each cleaned article its row of the cleaned table and one row per chunk (A4) of the vector table:
    ``table``, ``key`` (entry_id, or md5 of the chunk), ``content`` and the article's other columns."""
    item = lambda table, key, text: F.struct(F.lit(table).alias("table"), key.alias("key"), text.alias("content"))
    chunks = F.transform(chunk_text("cleaned_content"), lambda c: item(VECTORS, F.md5(c), c))
    items = F.concat(F.array(item(CLEANED, F.col("entry_id"), F.col("cleaned_content"))), F.coalesce(chunks, F.array()))
    others = ["entry_id", "seq", "source", "title", "summary", "published_at", "type"]
    return cleaned.select(F.explode(items).alias("i"), *others).select("i.*", *others)


def _write_changes(cleaned_path: str, vector_path: str, embed_dim: int):
    """K3: one batch of changes into both tables; only changed chunks are embedded."""
    def run(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()                            # the state is read once
        try:
            c = changed.where(F.col("table") == CLEANED)
            c = c.select("entry_id", "seq", "source", "title", F.col("content").alias("cleaned_content"), "summary",
                         "published_at", "type")
            K.upsert(cleaned_path, c, "entry_id", CLEANED_ORDER, batch_id)
            v = changed.where(F.col("table") == VECTORS)
            v = v.select(F.col("key").alias("chunk_id"), "entry_id", "seq", "title", "published_at", "type", "content",
                         hash_embed("content", embed_dim).alias("embedded_content"))
            K.upsert(vector_path, v, "chunk_id", VECTOR_ORDER, batch_id)
        finally:
            changed.unpersist()
    return run


@dataclass
class Flow:
    """Streaming queries that belong together."""

    queries: list

    def awaitTermination(self) -> None:  # noqa: N802  (as a query's own)
        for q in self.queries:
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def console_flow(spark: SparkSession, queue_dir: str, checkpoint: str, as_of: str, rows: int = 1000,
                 max_files_per_trigger: int = 64, trigger: dict | None = None):
    """K5: the cleaned stream on the console (``rows`` per micro-batch)."""
    cleaned = cleaned_messages(checked_messages(queue_source(spark, queue_dir, max_files_per_trigger), as_of))
    return (cleaned.writeStream.format("console").option("truncate", "false").option("numRows", rows)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def quarantine_flow(spark: SparkSession, queue_dir: str, quarantine_path: str, checkpoint: str, as_of: str,
                    max_files_per_trigger: int = 64, trigger: dict | None = None):
    """Refused lines as they came, with the reason; one folder per micro-batch."""
    refused = checked_messages(queue_source(spark, queue_dir, max_files_per_trigger), as_of)
    refused = refused.where(F.col("reason").isNotNull()).select("entry_id", "raw", "reason")
    return (refused.writeStream.foreachBatch(
                lambda df, b: df.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={b}"))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def feature_flow(spark: SparkSession, queue_dir: str, cleaned_path: str, vector_path: str, quarantine_path: str,
                 checkpoint: str, as_of: str, embed_dim: int = 384, max_files_per_trigger: int = 64,
                 console: bool = False, changes_only: bool = False, state_partitions: int | None = None,
                 trigger: dict | None = None) -> Flow:
    """One streaming query with keyed state feeds both tables, another the quarantine. ``as_of`` is the date
    of messages without one. ``console`` adds ``console_flow``. The checkpoints of the others lie beside this one.
    ``state_partitions`` and ``changes_only`` are fixed when the checkpoint is made: with ``changes_only`` the state
    holds versions instead of rows and what arrives again is written (and embedded) no more."""
    more = {"max_files_per_trigger": max_files_per_trigger, "trigger": trigger}
    cleaned = cleaned_messages(checked_messages(queue_source(spark, queue_dir, max_files_per_trigger), as_of))
    newest = newest_versions if changes_only else newest_rows
    changes = newest(keyed_rows(cleaned), ["table", "key"], *VECTOR_ORDER)
    writer = (changes.writeStream.outputMode("update").foreachBatch(_write_changes(cleaned_path, vector_path, embed_dim))
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    beside = checkpoint.rstrip("/")
    queries = [start_keyed(spark, writer.start, state_partitions),
               quarantine_flow(spark, queue_dir, quarantine_path, beside + "-quarantine", as_of, **more)]
    if console:
        queries.append(console_flow(spark, queue_dir, beside + "-console", as_of, **more))
    return Flow(queries)


def read_quarantine(spark: SparkSession, quarantine_path: str) -> DataFrame:
    return spark.read.option("basePath", quarantine_path).parquet(quarantine_path)
