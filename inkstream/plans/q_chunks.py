"""Registered queries for chunking and embedding (A1..A4, A6, A7, P4, V1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.functions import text as T
from inkstream.operators import chunking as C
from inkstream.operators import embedding as E
from inkstream.plans.registry import register
from inkstream.sources import fixtures as fx
from inkstream.sources.tables import read_table

# Injected view: every line break doubled, so texts carry blank-line sections for A1.
SECTIONED_SQL = "SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents"


def sectioned(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))


def cleaned_articles(spark, sf_dir):
    """Raw article -> cleaned article (``type`` becomes 'article')."""
    a = fx.articles(spark, sf_dir)
    return a.select("entry_id", "source", "title", T.clean_text("content").alias("cleaned_content"), "summary",
                    F.date_format("published_at", "yyyy-MM-dd").alias("published_at"),
                    F.lit("article").alias("type"), "doc_id")


CLEANED_SQL = (f"SELECT entry_id, source, title, {T.clean_text_sql('content')} AS cleaned_content, summary, "
               f"strftime(published_at, '%Y-%m-%d') AS published_at, 'article' AS type, doc_id FROM articles")


def article_chunks(spark, sf_dir):
    """A4: cleaned articles -> chunk rows (entry_id, title, published_at, type, chunk_no, chunk_id, text)."""
    return C.chunk_rows(cleaned_articles(spark, sf_dir), keep=("entry_id", "title", "published_at", "type"))


def chunks_sql_ctes() -> dict:
    """DuckDB CTEs (after `articles`) ending in `chunks`, the oracle of ``article_chunks``."""
    win = C.token_windows_sql("s")
    return {
        "cleaned": CLEANED_SQL,
        "sec_fold": C.section_split_cte("cleaned", "entry_id, title, published_at, type", "cleaned_content"),
        "sections": C.section_final_sql("entry_id, title, published_at, type"),
        "chunk_lists": f"SELECT entry_id, title, published_at, type, "
                       f"flatten(list_transform(sections, lambda s: {win})) AS cl FROM sections",
        "chunks": "SELECT entry_id, title, published_at, type, CAST(pos AS BIGINT) AS chunk_no, md5(c) AS chunk_id, "
                  "c AS chunk_content FROM (SELECT entry_id, title, published_at, type, UNNEST(range(len(cl))) AS pos, "
                  "UNNEST(cl) AS c FROM chunk_lists)",
    }


@register("clean_articles", "P4 P5 D6", fx.with_views(
    "SELECT entry_id, source, title, cleaned_content, summary, published_at, type FROM cleaned",
    "articles", extra={"cleaned": CLEANED_SQL}))
def clean_articles(spark, sf_dir):
    return cleaned_articles(spark, sf_dir).drop("doc_id")


@register("section_split", "A1", fx.with_views(
    "SELECT doc_id, CAST(pos AS BIGINT) AS section_no, s AS section FROM ("
    "SELECT doc_id, UNNEST(range(len(sections))) AS pos, UNNEST(sections) AS s FROM sections)",
    extra={"sectioned": SECTIONED_SQL, "sec_fold": C.section_split_cte("sectioned", "doc_id", "text"),
           "sections": C.section_final_sql("doc_id")}, recursive=True))
def section_split(spark, sf_dir):
    s = sectioned(spark, sf_dir)
    return s.select("doc_id", F.posexplode(C.section_split("text")).alias("section_no", "section")) \
        .select("doc_id", F.col("section_no").cast("bigint"), "section")


@register("token_windows", "A2", f"""
SELECT doc_id, CAST(pos AS BIGINT) AS window_no, md5(w) AS window_id, w AS window_text FROM (
  SELECT doc_id, UNNEST(range(len(ws))) AS pos, UNNEST(ws) AS w FROM (
    SELECT doc_id, {C.token_windows_sql('text')} AS ws FROM documents))""")
def token_windows(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", F.posexplode(C.token_windows("text")).alias("window_no", "window_text")) \
        .select("doc_id", F.col("window_no").cast("bigint"), F.md5("window_text").alias("window_id"), "window_text")


@register("chunk_text", "A3", fx.with_views(
    "SELECT entry_id, CAST(len(cl) AS BIGINT) AS n_chunks, md5(array_to_string(cl, chr(1))) AS chunks_md5 "
    "FROM chunk_lists", "articles", extra=chunks_sql_ctes(), recursive=True))
def chunk_text(spark, sf_dir):
    c = cleaned_articles(spark, sf_dir).select("entry_id", C.chunk_text("cleaned_content").alias("cl"))
    return c.select("entry_id", F.size("cl").cast("bigint").alias("n_chunks"),
                    F.md5(F.array_join("cl", "\u0001")).alias("chunks_md5"))


@register("chunk_articles", "A4 R3 D7", fx.with_views(
    "SELECT entry_id, title, published_at, type, chunk_no, chunk_id, chunk_content FROM chunks",
    "articles", extra=chunks_sql_ctes(), recursive=True))
def chunk_articles(spark, sf_dir):
    return article_chunks(spark, sf_dir)


FIXED_TOKENS = 1000


@register("fixed_windows", "A6", f"""
SELECT doc_id, CAST(pos AS BIGINT) AS window_no, CAST(len(string_split(w, ' ')) AS BIGINT) AS n_tokens,
       md5(w) AS window_id FROM (
  SELECT doc_id, UNNEST(range(len(ws))) AS pos, UNNEST(ws) AS w FROM (
    SELECT doc_id, {C.token_windows_sql('text', FIXED_TOKENS, 0)} AS ws FROM documents))""")
def fixed_windows(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    w = d.select("doc_id", F.posexplode(C.token_windows("text", FIXED_TOKENS, 0)).alias("window_no", "w"))
    return w.select("doc_id", F.col("window_no").cast("bigint"),
                    F.size(F.split("w", " ")).cast("bigint").alias("n_tokens"), F.md5("w").alias("window_id"))


@register("offset_limit", "A7", fx.with_views(
    "SELECT doc_id, entry_id, title FROM articles ORDER BY doc_id LIMIT 10 OFFSET 140", "articles"))
def offset_limit(spark, sf_dir):
    # ORDER BY + OFFSET + LIMIT plans as a distributed top-(offset+limit), never a full sort.
    return fx.articles(spark, sf_dir).select("doc_id", "entry_id", "title").orderBy("doc_id").offset(140).limit(10)


EMBED_CHECK_DIM = E.EMBED_DIM


@register("hash_embed", "V1 D8", fx.with_views(f"""
SELECT chunk_id, CAST(b AS INTEGER) AS dim_no, c / sqrt(sum(c * c) OVER (PARTITION BY chunk_id)) AS value
FROM (SELECT chunk_id, b, CAST(sum(sg) AS DOUBLE) AS c FROM (
        SELECT chunk_id, {E.token_bucket_sql('t', EMBED_CHECK_DIM)} AS b, {E.token_sign_sql('t')} AS sg
        FROM (SELECT DISTINCT chunk_id, chunk_content FROM chunks), UNNEST({E.words_sql('chunk_content')}) AS u(t))
      GROUP BY chunk_id, b)
WHERE c <> 0""", "articles", extra=chunks_sql_ctes(), recursive=True))
def hash_embed(spark, sf_dir):
    ch = article_chunks(spark, sf_dir).select("chunk_id", "chunk_content").dropDuplicates(["chunk_id"])
    v = ch.select("chunk_id", E.hash_embed("chunk_content", EMBED_CHECK_DIM).alias("vec"))
    return v.select("chunk_id", F.posexplode("vec").alias("dim_no", "value")).where(F.col("value") != 0)
