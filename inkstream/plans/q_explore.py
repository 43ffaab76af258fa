"""Registered queries for profiling and summaries (G6..G11, U1, U2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.functions import text as T
from inkstream.operators import profile as PR
from inkstream.operators.chunking import tokens_of
from inkstream.operators.embedding import words_sql
from inkstream.operators.indexing import join_null_safe
from inkstream.plans.q_chunks import article_chunks, chunks_sql_ctes
from inkstream.plans.q_dataset import NEXT_FIT_CTES
from inkstream.plans.q_ingest import _NONPROMO, sources_union
from inkstream.plans.registry import register
from inkstream.sources import fixtures as fx
from inkstream.sources.tables import read_table

TOP_TERMS = 5
TOP_SENTENCES = 3


@register("value_counts", "G6", fx.with_views(
    "SELECT strftime(published_at, '%Y-%m-%d') AS published_at, count(*) AS n FROM articles GROUP BY published_at",
    "articles"))
def value_counts(spark, sf_dir):
    a = fx.articles(spark, sf_dir).select(F.date_format("published_at", "yyyy-MM-dd").alias("published_at"))
    return PR.value_counts(a, "published_at")


@register("null_count", "G7", fx.with_views(
    "SELECT count(*) AS n_rows, CAST(sum(CASE WHEN content IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null_content "
    "FROM messages", "messages"))
def null_count(spark, sf_dir):
    return PR.null_count(fx.messages(spark, sf_dir), ["content"])


@register("link_count", "G8 T15", fx.with_views(
    f"SELECT count(*) FILTER (WHERE {T.has_links_sql('content')}) AS n_with_links FROM messages", "messages"))
def link_count(spark, sf_dir):
    return fx.messages(spark, sf_dir).agg(F.count_if(T.has_links("content")).alias("n_with_links"))


@register("describe_articles", "G9", """
SELECT 'n_chars' AS column, count(*) AS count, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std,
       CAST(min(n_chars) AS DOUBLE) AS min, quantile_cont(n_chars, 0.25) AS p25, quantile_cont(n_chars, 0.5) AS p50,
       quantile_cont(n_chars, 0.75) AS p75, CAST(max(n_chars) AS DOUBLE) AS max
FROM documents WHERE n_chars IS NOT NULL""")
def describe_articles(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", "doc_id", "n_chars")
    return PR.describe(d, "n_chars")


@register("count_by_source", "G10", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def count_by_source(spark, sf_dir):
    return PR.value_counts(read_table(spark, sf_dir, "documents", "source"), "source")


_DAY_DOCS = "SELECT strftime(published_at, '%Y-%m-%d') AS day, doc_id, content FROM articles"
_WEIGHTS = {
    "day_docs": _DAY_DOCS,
    "tf": f"SELECT day, term, count(*) AS tf FROM (SELECT day, UNNEST({words_sql('content')}) AS term FROM day_docs) "
          "GROUP BY day, term",
    "dfreq": "SELECT term, count(*) AS df FROM tf GROUP BY term",
    "weights": "SELECT day, term, tf, tf * ln((SELECT count(DISTINCT day) FROM day_docs) / df) AS weight "
               "FROM tf JOIN dfreq USING (term)",
}


def _day_docs(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    return a.select(F.date_format("published_at", "yyyy-MM-dd").alias("day"), "doc_id", "content")


@register("daily_top_terms", "G11", fx.with_views(f"""
SELECT day, rank, term, tf, weight FROM (
  SELECT day, term, tf, round(weight, 9) AS weight,
         row_number() OVER (PARTITION BY day ORDER BY round(weight, 9) DESC, term) AS rank FROM weights)
WHERE rank <= {TOP_TERMS}""", "articles", extra=_WEIGHTS))
def daily_top_terms(spark, sf_dir):
    return PR.daily_top_terms(_day_docs(spark, sf_dir), "day", "content", TOP_TERMS) \
        .select("day", "rank", "term", "tf", "weight")


_KEY_SENTENCES = f"""
SELECT day, rank, doc_id, sent_no, trim(sentence) AS sentence, score FROM (
  SELECT s.day, s.doc_id, s.sent_no, s.sentence, sc.score,
         row_number() OVER (PARTITION BY s.day ORDER BY sc.score DESC, s.doc_id, s.sent_no) AS rank
  FROM (SELECT day, doc_id, CAST(sent_no AS BIGINT) AS sent_no, sentence FROM (
          SELECT day, doc_id, UNNEST(range(len(ss))) AS sent_no, UNNEST(ss) AS sentence
          FROM (SELECT day, doc_id, regexp_split_to_array(content, '[.!?]') AS ss FROM day_docs))
        WHERE length(trim(sentence)) > 0) s
  JOIN (SELECT day, doc_id, sent_no, round(sum(coalesce(w.weight, 0)) / count(*), 9) AS score FROM (
          SELECT day, doc_id, sent_no, UNNEST({words_sql('sentence')}) AS term FROM (
            SELECT day, doc_id, UNNEST(range(len(ss))) AS sent_no, UNNEST(ss) AS sentence
            FROM (SELECT day, doc_id, regexp_split_to_array(content, '[.!?]') AS ss FROM day_docs))
          WHERE length(trim(sentence)) > 0) t
        LEFT JOIN weights w USING (day, term)
        GROUP BY day, doc_id, sent_no) sc USING (day, doc_id, sent_no))
WHERE rank <= {TOP_SENTENCES}"""


@register("daily_key_sentences", "G11", fx.with_views(_KEY_SENTENCES, "articles", extra=_WEIGHTS))
def daily_key_sentences(spark, sf_dir):
    return PR.daily_key_sentences(_day_docs(spark, sf_dir), "day", "doc_id", "content", TOP_SENTENCES)


#: Keeping the best of each pack and the best of those is keeping the best of the day; the first round's packs are
#: those of the sequential rule.
@register("summarise_days", "G1 G11", fx.with_views(f"""
SELECT k.*, n.n_packs FROM ({_KEY_SENTENCES}) k JOIN (
  SELECT strftime(published_at, '%Y-%m-%d') AS day, count(DISTINCT pack_no) AS n_packs FROM pk GROUP BY published_at) n USING (day)""",
    "articles", extra={**_WEIGHTS, **NEXT_FIT_CTES}, recursive=True))
def summarise_days(spark, sf_dir):
    docs = _day_docs(spark, sf_dir).withColumn("n_tokens", F.size(tokens_of("content")).cast("bigint"))
    summary, rounds = PR.combined_summary(docs, "day", "doc_id", "content", "n_tokens", TOP_SENTENCES)
    n = rounds[0].groupBy("day").agg(F.countDistinct("pack_no").alias("n_packs"))
    return join_null_safe(summary, n, ["day"])


@register("union_sources", "U1", fx.with_views(f"""
SELECT 'articles' AS origin, doc_id, source, title FROM articles
UNION ALL
SELECT 'messages', doc_id, channel, {T.first_sentence_sql('content')} FROM messages WHERE {_NONPROMO}""",
    "articles", "messages"))
def union_sources(spark, sf_dir):
    return sources_union(spark, sf_dir).select("origin", "doc_id", "source", "title")


@register("dedup_chunks", "U2", fx.with_views(
    "SELECT chunk_id, count(*) AS n_copies, min(entry_id) AS entry_id FROM chunks GROUP BY chunk_id",
    "articles", extra=chunks_sql_ctes(), recursive=True))
def dedup_chunks(spark, sf_dir):
    return PR.dedup_by_key(article_chunks(spark, sf_dir), "chunk_id", "entry_id")
