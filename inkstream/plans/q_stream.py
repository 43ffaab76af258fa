"""Registered queries for the streaming flows (S1, S2, S14, R1..R6, K3, K6).

Each key runs its streams with ``trigger(availableNow=True)`` into fresh folders under the shared
folder, waits for them, and returns what the sinks hold; the oracle is the equivalent batch SQL
(stream result = batch result).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.operators import tables as K
from inkstream.operators.chunking import chunk_rows
from inkstream.plans.q_chunks import chunks_sql_ctes, cleaned_articles
from inkstream.plans.registry import register
from inkstream.session import fresh_path, materialize
from inkstream.sources import fixtures as fx
from inkstream.sources.tables import read_table
from inkstream.streaming import flow as S
from inkstream.streaming.state import first_within, newest_versions, start_keyed

ENVELOPE_FILES = 8
AS_OF = "2024-07-26"          # date of messages that have none
REPUBLISHED = 10 ** 9         # added to seq of a message that is published again
# What the producer side holds besides plain articles, by seq: no date, no title, a later version with
# another title, and lines that are cut short.
NO_DATE, NO_TITLE, AGAIN, CUT = 13, 37, 29, 50

# The change feed's accepted article versions in the article shape (oracle side of the event pipeline).
_CDC_ARTICLES = f"""SELECT doc_key AS entry_id, source, CASE WHEN seq % {AGAIN} = 0 THEN 'Republished ' ELSE '' END ||
  regexp_extract(content, '^[^.!?\\r\\n]*', 0) AS title, content, CAST(NULL AS VARCHAR) AS summary,
  CASE WHEN seq % {NO_DATE} = 0 THEN DATE '{AS_OF}' ELSE DATE '2024-01-01' + CAST(seq % 30 AS INT) END AS published_at,
  seq + CASE WHEN seq % {AGAIN} = 0 THEN {REPUBLISHED} ELSE 0 END AS doc_id
FROM cdc_events WHERE op = 'insert' AND coll = 'articles' AND seq % {NO_TITLE} <> 0"""


def _landing_envelopes(spark, sf_dir) -> str:
    """Producer side of the change feed: envelopes derived from `documents`, as parquet files."""
    path = fresh_path(spark, "envelopes")
    doc, seq = F.col("fullDocument"), F.col("seq")
    e = fx.change_envelopes(spark, sf_dir).withColumn("fullDocument", doc.withField(
        "published_at", F.when(seq % NO_DATE != 0, doc["published_at"])).withField("title", F.when(seq % NO_TITLE != 0, doc["title"])))
    e.repartition(ENVELOPE_FILES).write.parquet(path)
    return path


def _publish_odd_messages(spark, sf_dir, queue: str) -> None:
    """Later versions of some articles, and lines that are no whole message, into the queue."""
    sent = spark.read.schema(S.MESSAGE_SCHEMA).json(queue)
    later = sent.where((F.col("seq") % AGAIN == 0) & (F.col("seq") < REPUBLISHED) & F.col("title").isNotNull())
    later = later.withColumn("seq", F.col("seq") + REPUBLISHED).withColumn("title", F.concat(F.lit("Republished "), "title"))
    S.publish_messages(materialize(later, "republished"), queue)
    d = read_table(spark, sf_dir, "documents", "doc_id").where(F.col("doc_id") % CUT == 0)
    d.select(F.concat(F.lit('{"seq": '), F.col("doc_id").cast("string"), F.lit(', "entry_id": "cut sho')).alias("value")) \
        .write.mode("append").text(queue)


def event_pipeline(spark, sf_dir, replay: bool = False) -> dict:
    """R5 then R1 over the change feed, into new folders; with ``replay`` the queue is published again
    and the feature flow, here with versions as its state, restarted from its checkpoint (R4)."""
    env = _landing_envelopes(spark, sf_dir)
    queue = fresh_path(spark, "queue")
    S.change_capture(spark, env, queue, fresh_path(spark, "ckpt-cdc")).awaitTermination()
    paths = {"queue": queue, "cleaned": fresh_path(spark, "cleaned"), "vectors": fresh_path(spark, "vectors"),
             "quarantine": fresh_path(spark, "quarantine")}
    if replay:   # versions and cut lines come after a first run
        _features(spark, paths, ckpt := fresh_path(spark, "ckpt-features"), changes_only=True)
    _publish_odd_messages(spark, sf_dir, queue)
    if not replay:
        ckpt = fresh_path(spark, "ckpt-features")
    _features(spark, paths, ckpt, changes_only=replay)
    if replay:
        # at-least-once: the same messages arrive again as new files, then the flow restarts
        again = materialize(spark.read.schema(S.MESSAGE_SCHEMA).json(queue).where("entry_id IS NOT NULL"), "again")
        S.publish_messages(again, queue)
        _features(spark, paths, ckpt, changes_only=True)
        _features(spark, paths, ckpt, changes_only=True)
    return paths


def _features(spark, paths: dict, checkpoint: str, changes_only: bool = False) -> None:
    S.feature_flow(spark, paths["queue"], paths["cleaned"], paths["vectors"], paths["quarantine"], checkpoint,
                   as_of=AS_OF, changes_only=changes_only,
                   state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()


def _captured(spark, sf_dir) -> str:
    """R5 alone: the queue folder after change capture."""
    queue = fresh_path(spark, "queue")
    S.change_capture(spark, _landing_envelopes(spark, sf_dir), queue, fresh_path(spark, "ckpt-cdc")).awaitTermination()
    return queue


@register("stream_queue_source", "S1 S2 S14", fx.with_views(
    "SELECT entry_id, type, source, title, strftime(published_at, '%Y-%m-%d') AS published_at FROM articles",
    "articles"))
def stream_queue_source(spark, sf_dir):
    queue, out = fresh_path(spark, "queue"), fresh_path(spark, "queue-out")
    a = fx.articles(spark, sf_dir)
    S.publish_messages(a.select(F.col("doc_id").alias("seq"), "type", "entry_id", "source", "title", "summary",
                                "content", F.date_format("published_at", "yyyy-MM-dd").alias("published_at")), queue)
    q = (S.queue_source(spark, queue).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", fresh_path(spark, "ckpt-queue")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("entry_id", "type", "source", "title", "published_at")


_CDC_MSG = (f"SELECT doc_key AS entry_id, coll AS type, source, CASE WHEN seq % {NO_TITLE} <> 0 THEN "
            "regexp_extract(content, '^[^.!?\\r\\n]*', 0) END AS title, "
            f"CASE WHEN seq % {NO_DATE} <> 0 THEN strftime(DATE '2024-01-01' + CAST(seq % 30 AS INT), '%Y-%m-%d') END AS published_at "
            "FROM cdc_events WHERE op = 'insert'")


@register("stream_cdc", "R5 S3 P1", fx.with_views(_CDC_MSG, "cdc_events"))
def stream_cdc(spark, sf_dir):
    return spark.read.schema(S.MESSAGE_SCHEMA).json(_captured(spark, sf_dir)).select(
        "entry_id", "type", "source", "title", "published_at")


@register("cdc_to_queue", "K6", fx.with_views(
    "SELECT doc_key AS entry_id, coll AS type, CAST(seq AS VARCHAR) AS seq FROM cdc_events WHERE op = 'insert'",
    "cdc_events"))
def cdc_to_queue(spark, sf_dir):
    raw = spark.read.text(_captured(spark, sf_dir))  # the serialised messages as published
    return raw.select(F.json_tuple("value", "entry_id", "type", "seq").alias("entry_id", "type", "seq"))


def _chunk_oracle(select: str) -> str:
    return fx.with_views(select, "cdc_events", extra={"articles": _CDC_ARTICLES, **chunks_sql_ctes()}, recursive=True)


@register("stream_feature_flow", "R1 R2 R3 K2 V1", _chunk_oracle(
    "SELECT chunk_id, entry_id, title, published_at FROM (SELECT c.*, row_number() OVER (PARTITION BY chunk_id "
    "ORDER BY a.doc_id DESC, entry_id DESC) AS n FROM chunks c JOIN (SELECT entry_id, doc_id FROM articles) a USING (entry_id)) WHERE n = 1"))
def stream_feature_flow(spark, sf_dir):
    p = event_pipeline(spark, sf_dir)
    v = K.read_keyed(spark, p["vectors"], "chunk_id", S.VECTOR_ORDER)
    return v.select("chunk_id", "entry_id", "title", "published_at")


@register("two_sink_flow", "K3 K1", _chunk_oracle(
    "SELECT 'cleaned_articles' AS table_name, count(*) AS n_rows FROM articles "
    "UNION ALL SELECT 'vector_articles', count(DISTINCT chunk_id) FROM chunks"))
def two_sink_flow(spark, sf_dir):
    p = event_pipeline(spark, sf_dir)
    c = K.read_keyed(spark, p["cleaned"], "entry_id", "seq").select(F.lit("cleaned_articles").alias("table_name"))
    v = K.read_keyed(spark, p["vectors"], "chunk_id", S.VECTOR_ORDER).select(F.lit("vector_articles").alias("table_name"))
    return c.unionByName(v).groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))


@register("stream_restart_no_dup", "R4", _chunk_oracle(
    "SELECT entry_id, title, cleaned_content, published_at FROM cleaned"))
def stream_restart_no_dup(spark, sf_dir):
    p = event_pipeline(spark, sf_dir, replay=True)
    return K.read_keyed(spark, p["cleaned"], "entry_id", "seq").select("entry_id", "title", "cleaned_content",
                                                                         "published_at")


@register("stream_restart_vectors", "R4 K2", _chunk_oracle(
    "SELECT chunk_id, max(a.doc_id) AS seq, 384 AS dim FROM chunks c JOIN (SELECT entry_id, doc_id FROM articles) a USING (entry_id) "
    "GROUP BY chunk_id"))
def stream_restart_vectors(spark, sf_dir):
    p = event_pipeline(spark, sf_dir, replay=True)
    return K.read_keyed(spark, p["vectors"], "chunk_id", S.VECTOR_ORDER).select(
        "chunk_id", "seq", F.size("embedded_content").alias("dim"))


@register("quarantine", "R6 P2", fx.with_views(f"""
SELECT doc_key AS entry_id, 'unsupported type: ' || coll AS reason, CAST(seq AS VARCHAR) AS raw_seq FROM cdc_events
WHERE op = 'insert' AND coll <> 'articles'
UNION ALL SELECT doc_key, 'unsupported type: ' || coll, CAST(seq + {REPUBLISHED} AS VARCHAR) FROM cdc_events
WHERE op = 'insert' AND coll <> 'articles' AND seq % {AGAIN} = 0 AND seq % {NO_TITLE} <> 0
UNION ALL SELECT doc_key, 'missing: title', CAST(seq AS VARCHAR) FROM cdc_events
WHERE op = 'insert' AND coll = 'articles' AND seq % {NO_TITLE} = 0
UNION ALL SELECT NULL, 'broken message', '{{"seq": ' || doc_id || ', "entry_id": "cut sho' FROM documents WHERE doc_id % {CUT} = 0""",
    "cdc_events"))
def quarantine(spark, sf_dir):
    """The refused lines as they came: the sequence number is read back from the line itself."""
    p = event_pipeline(spark, sf_dir)
    q = S.read_quarantine(spark, p["quarantine"])
    return q.select("entry_id", "reason", F.coalesce(F.get_json_object("raw", "$.seq"), "raw").alias("raw_seq"))


# ----------------------------------------------------------------------------- keyed state and watermarks
@register("stream_changes", "K1 R4", fx.with_views("""
SELECT batch_no, key, seq, source, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key, batch_no ORDER BY seq DESC) AS n,
    max(seq) OVER (PARTITION BY key ORDER BY batch_no RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM (SELECT *, seq % 3 AS batch_no FROM versions)) WHERE n = 1 AND (before IS NULL OR seq > before)""", "versions"))
def stream_changes(spark, sf_dir):
    """What each micro-batch changes: three parts arrive one after the other, each time the query starts again from
    its checkpoint, and the second arrives twice (its second arrival, batch 2, changes nothing)."""
    landing, out, ckpt = (fresh_path(spark, n) for n in ("versions-in", "versions-changes", "ckpt-changes"))
    v = fx.versions(spark, sf_dir)
    for part in (0, 1, 1, 2):
        v.where(F.col("seq") % 3 == part).write.mode("append").parquet(landing)
        changes = newest_versions(spark.readStream.schema(v.schema).parquet(landing), ["key"], "seq", "source")
        writer = (changes.writeStream.outputMode("update").option("checkpointLocation", ckpt).trigger(availableNow=True)
                  .foreachBatch(lambda df, b: df.write.mode("overwrite").parquet(f"{out}/b={b}")))
        start_keyed(spark, writer.start, spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(out).select((F.col("b") - (F.col("b") > 1).cast("int")).cast("bigint").alias("batch_no"),
                                          "key", "seq", "source", "value")


DELAY_DAYS = 20


@register("stream_dedup_chunks", "U2", fx.with_views(f"""
SELECT chunk_id, min(part) AS part FROM (SELECT c.chunk_id, a.doc_id % 2 AS part, CAST(c.published_at AS DATE) AS day
  FROM chunks c JOIN (SELECT entry_id, doc_id FROM articles) a USING (entry_id))
WHERE part = 0 OR day > (SELECT max(published_at) FROM articles WHERE doc_id % 2 = 0) - {DELAY_DAYS}
GROUP BY chunk_id""", "articles", extra=chunks_sql_ctes(), recursive=True))
def stream_dedup_chunks(spark, sf_dir):
    """Chunks of the articles with an even number, then of the others: a chunk leaves once, with the first part it
    stands in; chunks of the second part are late when their day is over ``DELAY_DAYS`` before the latest day so far."""
    landing, out, ckpt = (fresh_path(spark, n) for n in ("chunks-in", "chunks-once", "ckpt-chunks"))
    rows = chunk_rows(cleaned_articles(spark, sf_dir), keep=("doc_id", "published_at"))
    rows = materialize(rows.select("chunk_id", (F.col("doc_id") % 2).alias("part"),
                                   F.to_timestamp("published_at", "yyyy-MM-dd").alias("at")), "chunks-timed")
    for part in (0, 1):
        rows.where(F.col("part") == part).write.mode("append").parquet(landing)
        once = first_within(spark.readStream.schema(rows.schema).parquet(landing), ["chunk_id"], "at", f"{DELAY_DAYS} days")
        writer = (once.select("chunk_id", "part").writeStream.format("parquet").option("path", out)
                  .option("checkpointLocation", ckpt).trigger(availableNow=True))
        start_keyed(spark, writer.start, spark.sparkContext.defaultParallelism).awaitTermination()
    return spark.read.parquet(out)
