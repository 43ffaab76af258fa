"""Registered queries for keyed tables, file sinks and sources (K1, K2, K7..K13, S4..S7, P10, G12, U2).

Sink queries write into fresh folders under the shared folder (``spark.checkpoint.dir``) and return
what they read back, so the check covers the write path too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.functions import prompts as P
from inkstream.operators import tables as K
from inkstream.operators.indexing import join_null_safe
from inkstream.plans.q_chunks import CLEANED_SQL, chunks_sql_ctes, cleaned_articles
from inkstream.operators import chunking as C
from inkstream.plans.registry import register
from inkstream.session import fresh_path
from inkstream.sources import files as FS
from inkstream.sources import fixtures as fx


@register("upsert_cleaned", "K1 R4", fx.with_views(
    "SELECT key, arg_max(seq, seq) AS seq, arg_max(source, seq) AS source, arg_max(value, seq) AS value "
    "FROM versions GROUP BY key", "versions"))
def upsert_cleaned(spark, sf_dir):
    path, folded = fresh_path(spark, "keyed-versions"), fresh_path(spark, "keyed-folded")
    v = fx.versions(spark, sf_dir)
    K.upsert(path, v.where(F.col("seq") % 3 == 0), "key", "seq", 0)
    K.upsert(path, v.where(F.col("seq") % 3 == 1), "key", "seq", 1)
    K.upsert(path, v.where(F.col("seq") % 3 == 1), "key", "seq", 1)          # replay: no change
    K.compact(spark, path, folded, "key", "seq")
    K.upsert(folded, v.where(F.col("seq") % 3 == 2), "key", "seq", 1)
    return K.read_keyed(spark, folded, "key", "seq").select("key", "seq", "source", "value")


@register("upsert_chunks", "K2 U2 P6", fx.with_views(
    "SELECT chunk_id, entry_id, title FROM (SELECT c.*, row_number() OVER (PARTITION BY chunk_id ORDER BY a.doc_id DESC, "
    "entry_id DESC) AS n FROM chunks c JOIN (SELECT entry_id, doc_id FROM articles) a USING (entry_id)) WHERE n = 1",
    "articles", extra=chunks_sql_ctes(), recursive=True))
def upsert_chunks(spark, sf_dir):
    path = fresh_path(spark, "keyed-chunks")
    cl = cleaned_articles(spark, sf_dir)
    rows = C.chunk_rows(cl, keep=("entry_id", "title", "published_at", "doc_id"))
    cols = ["chunk_id", "entry_id", F.col("doc_id").alias("seq"), "title", "published_at", F.col("chunk_content").alias("content")]
    order = ("seq", "entry_id")                     # the later article wins, whatever its id
    K.upsert(path, rows.where(F.col("doc_id") % 2 == 1).select(*cols), "chunk_id", order, 0)
    K.upsert(path, rows.where(F.col("doc_id") % 2 == 0).select(*cols), "chunk_id", order, 1)
    return K.read_keyed(spark, path, "chunk_id", order).select("chunk_id", "entry_id", "title")


@register("scan_cleaned", "S4 S7 P10 D9", fx.with_views(
    "SELECT entry_id, cleaned_content FROM cleaned WHERE length(cleaned_content) > 0",
    "articles", extra={"cleaned": CLEANED_SQL}))
def scan_cleaned(spark, sf_dir):
    path = fresh_path(spark, "cleaned-articles")
    K.upsert(path, cleaned_articles(spark, sf_dir).drop("doc_id"), "entry_id", "entry_id", 0)
    # Full scan, no silent cap; only the two needed columns are read from the snapshot.
    t = K.read_keyed(spark, path, "entry_id", "entry_id")
    return t.select("entry_id", "cleaned_content").where(F.length("cleaned_content") > 0)


_ART_OUT = ("SELECT entry_id, source, title, content, strftime(published_at, '%Y-%m-%d') AS published_at "
            "FROM articles")
ART_SCHEMA = "entry_id string, source string, title string, content string, published_at string"


def _articles_out(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    return a.select("entry_id", "source", "title", "content",
                    F.date_format("published_at", "yyyy-MM-dd").alias("published_at"), "doc_id")


@register("bulk_append", "K7 K12", fx.with_views(_ART_OUT, "articles"))
def bulk_append(spark, sf_dir):
    path = fresh_path(spark, "articles-by-day")
    a = _articles_out(spark, sf_dir)
    FS.append_partitioned(a.where(F.col("doc_id") % 2 == 0).drop("doc_id"), path, "published_at", mode="overwrite")
    FS.append_partitioned(a.where(F.col("doc_id") % 2 == 0).drop("doc_id"), path, "published_at", mode="overwrite")
    FS.append_partitioned(a.where(F.col("doc_id") % 2 == 1).drop("doc_id"), path, "published_at", mode="append")
    return spark.read.schema(ART_SCHEMA).parquet(path).select("entry_id", "source", "title", "content", "published_at")


@register("csv_roundtrip", "S5 K9", fx.with_views(f"""
SELECT entry_id, source, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE title END AS title,
       CASE doc_id % 3 WHEN 0 THEN '  "' || content || chr(9) || ' ' ELSE content END AS content,
       strftime(published_at, '%Y-%m-%d') AS published_at, CAST(NULL AS VARCHAR) AS summary FROM articles""", "articles"))
def csv_roundtrip(spark, sf_dir):
    """With empty and missing titles, edge white space, quotes, and a column without values."""
    path = fresh_path(spark, "articles-csv")
    m4, a = F.col("doc_id") % 4, _articles_out(spark, sf_dir)
    a = a.withColumn("title", F.when(m4 == 0, "").when(m4 == 1, F.lit(None)).otherwise(F.col("title")))
    a = a.withColumn("content", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('  "'), "content", F.lit("\t "))).otherwise(F.col("content")))
    FS.write_csv(a.withColumn("summary", F.lit(None).cast("string")).drop("doc_id"), path)
    return FS.read_csv(spark, path, ART_SCHEMA + ", summary string")


@register("json_roundtrip", "S6 K10", fx.with_views(_ART_OUT, "articles"))
def json_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "articles-json")
    FS.write_json(_articles_out(spark, sf_dir).drop("doc_id"), path)
    return FS.read_json(spark, path, ART_SCHEMA)


@register("text_dump", "K11", fx.with_views(_ART_OUT, "articles"))
def text_dump(spark, sf_dir):
    path = fresh_path(spark, "articles-txt")
    FS.write_text_records(_articles_out(spark, sf_dir).drop("doc_id"), path)
    return FS.read_text_records(spark, path, ART_SCHEMA)


@register("get_or_create_batch", "K8", fx.with_views("""
SELECT r.source, r.title, coalesce(e.id, md5(coalesce(CAST(length(r.source) AS VARCHAR) || ':' || r.source, '-') ||
       coalesce(CAST(length(r.title) AS VARCHAR) || ':' || r.title, '-'))) AS id, e.id IS NULL AS created, coalesce(e.n, 1) AS n_rows
FROM (SELECT DISTINCT source, title FROM articles) r
LEFT JOIN (SELECT source, title, min(entry_id) AS id, count(*) AS n FROM articles WHERE doc_id % 3 = 0 GROUP BY source, title) e
  ON e.source IS NOT DISTINCT FROM r.source AND e.title IS NOT DISTINCT FROM r.title""", "articles"))
def get_or_create_batch(spark, sf_dir):
    path = fresh_path(spark, "articles-existing")
    a = fx.articles(spark, sf_dir)
    a.where(F.col("doc_id") % 3 == 0).select("source", "title", F.col("entry_id").alias("id")).write.parquet(path)
    requests, keys = a.select("source", "title"), ["source", "title"]
    got = K.get_or_create_rows(spark, path, requests, keys, "id")
    again = K.get_or_create_rows(spark, path, requests, keys, "id")   # everything exists now
    rows = spark.read.parquet(path).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    same = again.where(~F.col("created")).select("id").distinct()
    found = got.join(same, "id", "left_semi").select(*keys, "id", "created")
    return join_null_safe(found, rows, keys)


# Span categories of the answer log.
SPAN_CATEGORY = {"retrieval_step": "Vector Retrieval", "generation_step": "LLM Generation",
                 "llm_eval_step": "Evaluation", "rag_eval_step": "Evaluation"}


@register("span_durations", "K13 G12 D15 D16", fx.with_views("""
SELECT span, CASE span WHEN 'retrieval_step' THEN 'Vector Retrieval' WHEN 'generation_step' THEN 'LLM Generation'
             ELSE 'Evaluation' END AS category,
       count(*) AS n, round(avg(duration), 6) AS avg_duration, max(duration) AS max_duration,
       min(duration) AS min_duration
FROM spans GROUP BY span""", "spans"))
def span_durations(spark, sf_dir):
    path = fresh_path(spark, "answer-log")
    s = fx.spans(spark, sf_dir)
    cat = F.lit(None).cast("string")
    for name, c in SPAN_CATEGORY.items():
        cat = F.when(F.col("span") == name, F.lit(c)).otherwise(cat)
    logs = s.select("event_id", F.array(F.struct(F.col("span").alias("name"), cat.alias("category"),
                                                 F.col("duration").alias("duration"))).alias("spans"))
    logs.write.mode("append").parquet(path)
    ex = spark.read.parquet(path).select(F.explode("spans").alias("s")).select("s.*")
    return ex.groupBy(F.col("name").alias("span"), "category").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("duration"), 6).alias("avg_duration"),
        F.max("duration").alias("max_duration"), F.min("duration").alias("min_duration"))


# ----------------------------------------------------------------------------- answer log
SPAN_NAMES = tuple(SPAN_CATEGORY)
LOG_MODEL = "own-model"


def answer_log(answers):
    """One record per answer: prompt, output, template, its variables, metadata, and the four spans
    of the answer with inputs, outputs and duration (milliseconds, here derived from the record's key)."""
    question, text = F.col("question"), F.col("answer")
    key = F.col("conv_id") * 31 + F.col("turn") * 17
    outputs = {"retrieval_step": ("retrieved_context", text), "generation_step": ("generation", text),
               "llm_eval_step": ("llm_eval_result", F.lit("ok")), "rag_eval_step": ("rag_eval_scores", F.lit("{}"))}
    spans = F.array(*[F.struct(
        F.lit(name).alias("name"), F.lit(SPAN_CATEGORY[name]).alias("category"),
        F.create_map(F.lit("user_query"), question).alias("inputs"),
        F.create_map(F.lit(outputs[name][0]), outputs[name][1]).alias("outputs"),
        ((key + k * 101) % (200 * (k + 1))).cast("long").alias("duration")) for k, name in enumerate(SPAN_NAMES)])
    return answers.select(
        "conv_id", "turn", P.fill(P.SIMPLE_PROMPT, question=question).alias("prompt"), text.alias("output"),
        F.lit(P.SIMPLE_PROMPT).alias("prompt_template"), F.create_map(F.lit("question"), question).alias("prompt_template_variables"),
        F.create_map(F.lit("model"), F.lit(LOG_MODEL)).alias("metadata"), spans.alias("spans"))


def _logged(spark, sf_dir):
    path = fresh_path(spark, "answer-log")
    answer_log(fx.answers(spark, sf_dir)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register("prompt_log", "K13 D15", fx.with_views(f"""
SELECT conv_id, turn, 'You are an AI language model assistant. Your task is to generate a cohesive and concise response to the user question.'
       || chr(10) || '    Question: ' || question || chr(10) || '    ' AS prompt, answer AS output, question AS variable,
       '{LOG_MODEL}' AS model, 4 AS n_spans, answer AS context FROM answers""", "answers"))
def prompt_log(spark, sf_dir):
    span = F.filter("spans", lambda s: s["name"] == "retrieval_step")[0]
    return _logged(spark, sf_dir).select(
        "conv_id", "turn", "prompt", "output", F.col("prompt_template_variables")["question"].alias("variable"),
        F.col("metadata")["model"].alias("model"), F.size("spans").alias("n_spans"),
        span["outputs"]["retrieved_context"].alias("context"))


@register("answer_log_spans", "K13 G12 D16", fx.with_views(" UNION ALL ".join(f"""
SELECT '{name}' AS span, '{SPAN_CATEGORY[name]}' AS category, count(*) AS n, round(avg(d), 6) AS avg_duration,
       quantile_cont(d, 0.5) AS p50, quantile_cont(d, 0.95) AS p95, max(d) AS max_duration
FROM (SELECT (conv_id * 31 + turn * 17 + {k * 101}) % {200 * (k + 1)} AS d FROM answers)""" for k, name in enumerate(SPAN_NAMES)), "answers"))
def answer_log_spans(spark, sf_dir):
    s = _logged(spark, sf_dir).select(F.explode("spans").alias("s")).select("s.name", "s.category", "s.duration")
    # durations are whole milliseconds: exact percentiles come from the counts of distinct values
    return s.groupBy(F.col("name").alias("span"), "category").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("duration"), 6).alias("avg_duration"),
        F.percentile("duration", 0.5).alias("p50"), F.percentile("duration", 0.95).alias("p95"),
        F.max("duration").alias("max_duration"))
