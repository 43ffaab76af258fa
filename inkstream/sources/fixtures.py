"""Derived record shapes, built from the given tables.

Each view exists twice: as a Spark DataFrame builder (used by the registered queries) and as a
DuckDB SQL body (used by the oracle SQL through ``with_views``). Both compute the same rows; they are
the record shapes the pipeline works on (articles, channel messages, change envelopes, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstream.sources.tables import read_table

# Fixed values of the derived views (from FIXTURES.md): base date, noise prefix and suffix.
BASE_DATE = "2024-01-01"
NOISE_PREFIX = "<b>x</b> 𝗕𝗧𝗖 𝘦𝘵𝘩 𝟭𝟬 😀→ “"
NOISE_MIDDLE = "” 12/05/2024 at 10:30 AM, &apos;q&apos; https://news.example/"
NOISE_SUFFIX = " www.a.example  end"


def day_of(doc_id: Column) -> Column:
    return F.date_add(F.lit(BASE_DATE).cast("date"), (doc_id % 30).cast("int"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return d.select(
        F.md5(F.col("doc_id").cast("string")).alias("entry_id"),
        F.lit("articles").alias("type"),
        "source",
        F.regexp_extract("text", r"^[^.!?\r\n]*", 0).alias("title"),
        F.col("text").alias("content"),
        F.lit(None).cast("string").alias("summary"),
        day_of(F.col("doc_id")).alias("published_at"),
        "doc_id",
    )


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select(
        "doc_id",
        F.concat(F.lit(NOISE_PREFIX), "text", F.lit(NOISE_MIDDLE), F.col("doc_id").cast("string"),
                 F.lit(NOISE_SUFFIX)).alias("text"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    doc_id = F.col("doc_id")
    return d.select(
        "doc_id",
        F.col("source").alias("channel"),
        day_of(doc_id).alias("published_at"),
        F.when(doc_id % 5 == 0, F.concat("text", F.lit(" https://news.example/"), doc_id.cast("string")))
        .when(doc_id % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("text")).alias("content"),
    )


def cdc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    doc_id = F.col("doc_id")
    m = doc_id % 4
    return d.select(
        doc_id.alias("seq"),
        F.when(m == 0, "update").when(m == 3, "delete").otherwise("insert").alias("op"),
        F.when(doc_id % 17 == 0, "users").otherwise("articles").alias("coll"),
        F.md5(doc_id.cast("string")).alias("doc_key"),
        F.col("text").alias("content"),
        "source",
    )


def change_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested change-feed envelope: operationType, ns.coll, fullDocument{_id, ...}."""
    c = cdc_events(spark, sf_dir)
    return c.select(
        "seq",
        F.col("op").alias("operationType"),
        F.struct(F.col("coll").alias("coll")).alias("ns"),
        F.struct(
            F.col("doc_key").alias("_id"),
            "source",
            F.regexp_extract("content", r"^[^.!?\r\n]*", 0).alias("title"),
            "content",
            F.lit(None).cast("string").alias("summary"),
            F.date_format(day_of(F.col("seq")), "yyyy-MM-dd").alias("published_at"),
        ).alias("fullDocument"),
    )


# Texts and what they mean, written down by hand (the oracle of date parsing).
DATE_TEXTS = (
    ("2024-05-06", "2024-05-06 00:00:00"), ("2024-05-06T01:02:03Z", "2024-05-06 01:02:03"),
    ("2024-05-06T01:02:03+00:00", "2024-05-06 01:02:03"), ("2024-05-06T23:02:03.123Z", "2024-05-06 23:02:03"),
    ("2024-05-06T01:02:03", "2024-05-06 01:02:03"), ("2024-05-06 01:02:03-0500", "2024-05-06 01:02:03"),
    ("May 6, 2024", "2024-05-06 00:00:00"), ("6 May 2024", "2024-05-06 00:00:00"), ("05/06/2024", "2024-05-06 00:00:00"),
    ("26/05/2024", "2024-05-26 00:00:00"), ("Mon, 6 May 2024 10:30:00 GMT", "2024-05-06 10:30:00"),
    ("Sept. 3rd, 2024 at 10:30 PM", "2024-09-03 22:30:00"), ("20240506", "2024-05-06 00:00:00"),
    ("2024/5/6 9:05", "2024-05-06 09:05:00"), ("2024-03-10 02:30:00", "2024-03-10 02:30:00"),
    ("December 31 2024 12:15 am", "2024-12-31 00:15:00"), ("not a date", None), ("2024-13-40", None), ("", None),
    ("30 Foo 2024", None), ("2024-05-06 later", None),
)


def date_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id")
    doc_id = F.col("doc_id")
    m5 = doc_id % 5
    raw = F.element_at(F.array(*[F.lit(t) for t, _ in DATE_TEXTS]), (doc_id % len(DATE_TEXTS) + 1).cast("int"))
    return d.select(
        "doc_id",
        raw.alias("raw_date"),
        F.concat(
            (1 + doc_id % 9).cast("string"),
            F.when(m5 == 0, " minutes").when(m5 == 1, " hours").when(m5 == 2, " day")
            .when(m5 == 3, " weeks").otherwise(" months"),
        ).alias("raw_delta"),
    )


def queries_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query vectors from the whole `embeddings` table: every row with vec_id % 100 = 0 (query_id -1 - vec_id, one
    variant), and for each label three variants, the centroids of its vectors split by vec_id % 3: a hash
    aggregate with a partial step per (label, variant, dimension), so a label holding a third of the
    vectors is reduced map-side."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    dims = e.select("label", (F.col("vec_id") % 3).cast("int").alias("variant_no"),
                    F.posexplode("embedding").alias("d", "x"))
    cent = dims.groupBy("label", "variant_no", "d").agg(F.avg(F.col("x").cast("double")).alias("v"))
    vecs = cent.groupBy("label", "variant_no").agg(F.array_sort(F.collect_list(F.struct("d", "v"))).alias("dv"))
    centroids = vecs.select(F.col("label").cast("bigint").alias("query_id"), "variant_no",
                            F.transform("dv", lambda t: t["v"]).alias("q"))
    rows = e.where(F.col("vec_id") % 100 == 0).select(
        (-1 - F.col("vec_id")).cast("bigint").alias("query_id"), F.lit(0).alias("variant_no"),
        F.transform("embedding", lambda x: x.cast("double")).alias("q"))
    return centroids.unionByName(rows)


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    u = c.where(F.col("role") == "user").alias("u")
    a = c.where(F.col("role") == "assistant").alias("a")
    return u.join(a, (F.col("a.conv_id") == F.col("u.conv_id")) & (F.col("a.turn") == F.col("u.turn") + 1)).select(
        F.col("u.conv_id").alias("conv_id"), F.col("u.turn").alias("turn"),
        F.col("u.text").alias("question"), F.col("a.text").alias("answer"),
    )


def llm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id")
    doc_id = F.col("doc_id")
    sid = doc_id.cast("string")
    return d.select(
        "doc_id",
        F.when(doc_id % 7 == 0, "sorry, no list").otherwise(
            F.concat(F.lit('Here: [{"instruction":"write item '), sid, F.lit('","content":"0"}] done'))
        ).alias("raw"),
        F.concat(
            F.lit("Relevance - "), (1 + doc_id % 5).cast("string"), F.lit("\nok\nCoherence - "),
            (1 + doc_id % 3).cast("string"), F.lit("\nok\nConciseness - "), (1 + doc_id % 4).cast("string"),
        ).alias("grade"),
        F.concat(F.lit(" q one "), sid, F.lit("#next-question#  #next-question# q two")).alias("expansion"),
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value")
    return e.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"),
                    F.col("event_type").alias("source"), "value")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", "event_id", "event_type", "value")
    t = F.col("event_type")
    return e.select(
        "event_id",
        F.when(t == "view", "retrieval_step").when(t == "click", "generation_step")
        .when(t == "purchase", "llm_eval_step").otherwise("rag_eval_step").alias("span"),
        F.col("value").alias("duration"),
    )


# ---------------------------------------------------------------------------------------------
# DuckDB bodies of the same views (oracle side). Written once; ``with_views`` prepends the ones a
# query names.
SQL_VIEWS = {
    "articles": r"""
SELECT md5(CAST(doc_id AS VARCHAR)) AS entry_id, 'articles' AS type, source,
       regexp_extract(text, '^[^.!?\r\n]*', 0) AS title, text AS content,
       CAST(NULL AS VARCHAR) AS summary,
       DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS published_at, doc_id
FROM documents""",
    "noisy": r"""
SELECT doc_id, concat('<b>x</b> 𝗕𝗧𝗖 𝘦𝘵𝘩 𝟭𝟬 😀→ “', text, '” 12/05/2024 at 10:30 AM, &apos;q&apos; https://news.example/',
       CAST(doc_id AS VARCHAR), ' www.a.example  end') AS text
FROM documents""",
    "messages": r"""
SELECT doc_id, source AS channel, DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS published_at,
       CASE WHEN doc_id % 5 = 0 THEN concat(text, ' https://news.example/', CAST(doc_id AS VARCHAR))
            WHEN doc_id % 11 = 0 THEN CAST(NULL AS VARCHAR) ELSE text END AS content
FROM documents""",
    "cdc_events": r"""
SELECT doc_id AS seq,
       CASE doc_id % 4 WHEN 0 THEN 'update' WHEN 3 THEN 'delete' ELSE 'insert' END AS op,
       CASE WHEN doc_id % 17 = 0 THEN 'users' ELSE 'articles' END AS coll,
       md5(CAST(doc_id AS VARCHAR)) AS doc_key, text AS content, source
FROM documents""",
    "date_strings": r"""
SELECT doc_id,
       concat(CAST(1 + doc_id % 9 AS VARCHAR),
              CASE doc_id % 5 WHEN 0 THEN ' minutes' WHEN 1 THEN ' hours' WHEN 2 THEN ' day'
                              WHEN 3 THEN ' weeks' ELSE ' months' END) AS raw_delta
FROM documents""",
    "queries_v": r"""
SELECT CAST(-1 - vec_id AS BIGINT) AS query_id, 0 AS variant_no, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS q
FROM embeddings WHERE vec_id % 100 = 0
UNION ALL SELECT CAST(label AS BIGINT) AS query_id, variant_no, list(v ORDER BY d) AS q FROM (
  SELECT label, variant_no, d, avg(CAST(x AS DOUBLE)) AS v FROM (
    SELECT label, CAST(vec_id % 3 AS INTEGER) AS variant_no, UNNEST(range(len(embedding))) AS d,
           UNNEST(embedding) AS x FROM embeddings)
  GROUP BY label, variant_no, d)
GROUP BY label, variant_no""",
    "answers": r"""
SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'""",
    "llm_text": r"""
SELECT doc_id,
       CASE WHEN doc_id % 7 = 0 THEN 'sorry, no list'
            ELSE concat('Here: [{"instruction":"write item ', CAST(doc_id AS VARCHAR), '","content":"0"}] done') END AS raw,
       concat('Relevance - ', CAST(1 + doc_id % 5 AS VARCHAR), chr(10), 'ok', chr(10), 'Coherence - ',
              CAST(1 + doc_id % 3 AS VARCHAR), chr(10), 'ok', chr(10), 'Conciseness - ', CAST(1 + doc_id % 4 AS VARCHAR)) AS grade,
       concat(' q one ', CAST(doc_id AS VARCHAR), '#next-question#  #next-question# q two') AS expansion
FROM documents""",
    "versions": r"""
SELECT user_id AS key, event_id AS seq, event_type AS source, value FROM events""",
    "spans": r"""
SELECT event_id, CASE event_type WHEN 'view' THEN 'retrieval_step' WHEN 'click' THEN 'generation_step'
       WHEN 'purchase' THEN 'llm_eval_step' ELSE 'rag_eval_step' END AS span, value AS duration
FROM events""",
}


def with_views(sql: str, *names: str, extra: dict | None = None, recursive: bool = False) -> str:
    """Prefix ``sql`` with CTEs for the named fixture views (and any extra CTE bodies, in order)."""
    parts = [f"{n} AS ({SQL_VIEWS[n]}\n)" for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v}\n)")
    if not parts:
        return sql
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + sql
