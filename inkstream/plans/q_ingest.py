"""Registered queries for sources and record operators (S3, S8..S13, S15, P1..P3, P7..P9, P11, P13, K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.functions import text as T
from inkstream.operators import records as R
from inkstream.plans.registry import register
from inkstream.sources import fixtures as fx
from inkstream.sources import html as H
from inkstream.sources.tables import read_table

AS_OF = "2024-01-15"
CHANNEL_N = 3
SINCE_DAY = "2024-01-20"


# Every third page gets a second article (with summary, date and an advert), every seventh a third.
SECOND = ('<article class="x"><h1>Second <i>piece</i></h1> <div>In short</div><time datetime="2024-05-06T01:02:03Z">x</time>'
          '<p>One</p><p>Advertisement here</p><p>Two &amp; three</article>')
THIRD = "<article><p>Only text</p></article>"


@register("html_articles", "S8", f"""
SELECT page_id, 0 AS article_no, {H.extract_article_sql("regexp_extract(html, '(?s)<article>(.*)</article>', 1)")} FROM pages
UNION ALL SELECT page_id, 1, 'Second piece', 'In short', '2024-05-06', 'One Two & three' FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END, '', NULL, NULL, 'Only text' FROM pages WHERE page_id % 7 = 0""")
def html_articles(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", "page_id", "html")
    more = [F.when(F.col("page_id") % n == 0, F.lit(text)).otherwise("") for n, text in ((3, SECOND), (7, THIRD))]
    p = p.select("page_id", F.posexplode(H.article_bodies(F.concat("html", *more))).alias("article_no", "body"))
    return p.select("page_id", "article_no", *H.extract_article("body"))


@register("html_block_text", "S9", f"SELECT page_id, {H.block_text_join_sql('html')} AS content FROM pages")
def html_block_text(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", "page_id", "html")
    return p.select("page_id", H.block_text_join("html").alias("content"))


@register("url_topic_title", "S10", f"SELECT page_id, {H.url_topic_title_sql('url')} FROM pages")
def url_topic_title(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", "page_id", "url")
    return p.select("page_id", *H.url_topic_title("url"))


_FEED_COLS = ("source, strftime(published_at, '%Y-%m-%d') AS published_at, "
              f"{T.first_sentence_sql('content')} AS title, content, rank")


def _feed_out(df):
    return df.select(F.col("channel").alias("source"), F.date_format("published_at", "yyyy-MM-dd").alias("published_at"),
                     T.first_sentence("content").alias("title"), "content", "rank")


_NONPROMO = f"content IS NOT NULL AND NOT {T.has_links_sql('content')}"


@register("latest_n_per_channel", "S11", fx.with_views(f"""
SELECT {_FEED_COLS} FROM (
  SELECT channel AS source, published_at, content,
         row_number() OVER (PARTITION BY channel ORDER BY published_at DESC, doc_id DESC) AS rank
  FROM messages WHERE {_NONPROMO}) WHERE rank <= {CHANNEL_N}""", "messages"))
def latest_n_per_channel(spark, sf_dir):
    return _feed_out(R.latest_per_channel(fx.messages(spark, sf_dir), CHANNEL_N))


@register("first_n_since_day", "S12", fx.with_views(f"""
SELECT {_FEED_COLS} FROM (
  SELECT channel AS source, published_at, content,
         row_number() OVER (PARTITION BY channel ORDER BY published_at, doc_id) AS rank
  FROM messages WHERE {_NONPROMO} AND published_at >= DATE '{SINCE_DAY}') WHERE rank <= {CHANNEL_N}""", "messages"))
def first_n_since_day(spark, sf_dir):
    return _feed_out(R.latest_per_channel(fx.messages(spark, sf_dir), CHANNEL_N, since=SINCE_DAY))


API_START, API_END = "2024-01-03", "2024-01-12"


_API_SQL = f"""
SELECT 'news_api' AS source, strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INT), '%Y-%m-%d') AS published_at,
       regexp_extract(text, '^[^.!?\\r\\n]*', 0) AS title, text AS content, source AS summary, lang AS language
FROM documents
WHERE lang = 'en' AND DATE '2024-01-01' + CAST(doc_id % 30 AS INT) BETWEEN DATE '{API_START}' AND DATE '{API_END}'"""
API_PAGE, API_PAGE_SIZE = 1, 50


def _api_responses(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    arts = d.select("doc_id", "source", "lang", F.regexp_extract("text", r"^[^.!?\r\n]*", 0).alias("title"),
                    F.col("text").alias("content"), fx.day_of(F.col("doc_id")).alias("published_at"))
    return R.api_responses(arts, API_PAGE_SIZE)


@register("api_records_to_articles", "S13", _API_SQL)
def api_records_to_articles(spark, sf_dir):
    return R.api_records_to_articles(_api_responses(spark, sf_dir), "en", API_START, API_END)


@register("api_page", "S13", _API_SQL + f" AND doc_id BETWEEN {API_PAGE * API_PAGE_SIZE} AND {(API_PAGE + 1) * API_PAGE_SIZE - 1}")
def api_page(spark, sf_dir):
    return R.api_records_to_articles(_api_responses(spark, sf_dir), "en", API_START, API_END, page=API_PAGE)


@register("frame_to_documents", "S15", fx.with_views(
    "SELECT content AS page_content, entry_id, source, title FROM articles", "articles"))
def frame_to_documents(spark, sf_dir):
    d = R.frame_to_documents(fx.articles(spark, sf_dir).drop("doc_id"), "content")
    return d.select("page_content", "metadata.entry_id", "metadata.source", "metadata.title")


_CDC_DOC = ("c.doc_key AS entry_id, c.coll AS type, c.source, regexp_extract(c.content, '^[^.!?\\r\\n]*', 0) AS title, "
            "c.content, CAST(NULL AS VARCHAR) AS summary, "
            "strftime(DATE '2024-01-01' + CAST(c.seq % 30 AS INT), '%Y-%m-%d') AS published_at")


@register("cdc_insert_filter", "S3", fx.with_views(
    "SELECT seq, op AS operationType, coll FROM cdc_events WHERE op = 'insert'", "cdc_events"))
def cdc_insert_filter(spark, sf_dir):
    e = R.insert_only(fx.change_envelopes(spark, sf_dir))
    return e.select("seq", "operationType", F.col("ns.coll").alias("coll"))


@register("cdc_flatten", "P1 P15", fx.with_views(
    f"SELECT {_CDC_DOC} FROM cdc_events c WHERE c.op = 'insert'", "cdc_events"))
def cdc_flatten(spark, sf_dir):
    return R.flatten_change(R.insert_only(fx.change_envelopes(spark, sf_dir)))


@register("raw_dispatch", "P2 R6", fx.with_views(
    "SELECT doc_key AS entry_id, coll AS type, CASE WHEN coll = 'articles' THEN NULL "
    "ELSE 'unsupported type: ' || coll END AS reason FROM cdc_events WHERE op = 'insert'", "cdc_events"))
def raw_dispatch(spark, sf_dir):
    flat = R.flatten_change(R.insert_only(fx.change_envelopes(spark, sf_dir)))
    return R.dispatch(flat).select("entry_id", "type", "reason")


def raw_messages(spark, sf_dir):
    """Raw queue messages from channel posts; every 13th lacks a date (to exercise the default)."""
    m = R.messages_as_articles(fx.messages(spark, sf_dir))
    return m.withColumn("published_at", F.when(F.col("doc_id") % 13 == 0, F.lit(None).cast("string"))
                        .otherwise(F.date_format("published_at", "yyyy-MM-dd")))


_RAW_MSG = ("SELECT md5(channel || ':' || CAST(doc_id AS VARCHAR)) AS entry_id, content, "
            "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE strftime(published_at, '%Y-%m-%d') END AS published_at "
            "FROM messages")


@register("validate_raw", "P3 E2 R6", fx.with_views(f"""
SELECT entry_id, CASE WHEN content IS NULL THEN 'missing: content' END AS reason,
       coalesce(published_at, '{AS_OF}') AS published_at FROM raw""", "messages", extra={"raw": _RAW_MSG}))
def validate_raw(spark, sf_dir):
    return R.validate(raw_messages(spark, sf_dir), AS_OF).select("entry_id", "reason", "published_at")


@register("route_by_type", "K4", fx.with_views(
    "SELECT doc_key AS entry_id, CASE WHEN coll = 'articles' THEN 'cleaned_articles' ELSE 'quarantine' END AS target "
    "FROM cdc_events WHERE op = 'insert'", "cdc_events"))
def route_by_type(spark, sf_dir):
    flat = R.flatten_change(R.insert_only(fx.change_envelopes(spark, sf_dir)))
    return flat.select("entry_id", R.route(flat, {"articles": "cleaned_articles"}).alias("target"))


DATE_LO, DATE_HI = "2024-01-05", "2024-01-12"


@register("date_range", "P7", fx.with_views(
    f"SELECT doc_id, strftime(published_at, '%Y-%m-%d') AS published_at FROM articles "
    f"WHERE published_at BETWEEN DATE '{DATE_LO}' AND DATE '{DATE_HI}'", "articles"))
def date_range(spark, sf_dir):
    a = R.date_range(fx.articles(spark, sf_dir), DATE_LO, DATE_HI)
    return a.select("doc_id", F.date_format("published_at", "yyyy-MM-dd").alias("published_at"))


def sources_union(spark, sf_dir):
    """Articles and non-promotional channel messages in one article-shaped table (duplicates kept)."""
    arts = fx.articles(spark, sf_dir).select(*R.ARTICLE_COLS, "doc_id")
    msgs = R.messages_as_articles(R.non_promotional(fx.messages(spark, sf_dir))).select(*R.ARTICLE_COLS, "doc_id")
    return arts.withColumn("origin", F.lit("articles")).unionByName(msgs.withColumn("origin", F.lit("messages")),
                                                                    allowMissingColumns=True)


def ingest(spark, sf_dir, mode: str, as_of: str):
    """P8 / §3.1: sources -> article shape -> date bounds of the mode -> one union."""
    lo, hi = R.ingest_bounds(mode, as_of)
    return R.date_range(sources_union(spark, sf_dir), lo, hi)


def _ingest_sql(lo: str, hi: str) -> str:
    return fx.with_views(f"""
SELECT origin, doc_id, strftime(published_at, '%Y-%m-%d') AS published_at, title FROM (
  SELECT 'articles' AS origin, doc_id, published_at, title FROM articles
  UNION ALL
  SELECT 'messages', doc_id, published_at, {T.first_sentence_sql('content')} FROM messages WHERE {_NONPROMO})
WHERE published_at BETWEEN DATE '{lo}' AND DATE '{hi}'""", "articles", "messages")


def _ingest_out(df):
    return df.select("origin", "doc_id", F.date_format("published_at", "yyyy-MM-dd").alias("published_at"), "title")


@register("ingest_daily", "P8", _ingest_sql(*R.ingest_bounds("daily", AS_OF)))
def ingest_daily(spark, sf_dir):
    return _ingest_out(ingest(spark, sf_dir, "daily", AS_OF))


@register("ingest_backfill", "P8 U1", _ingest_sql(*R.ingest_bounds("backfill", AS_OF)))
def ingest_backfill(spark, sf_dir):
    return _ingest_out(ingest(spark, sf_dir, "backfill", AS_OF))


@register("non_promotional", "P9", fx.with_views(
    f"SELECT doc_id, channel, content FROM messages WHERE {_NONPROMO}", "messages"))
def non_promotional(spark, sf_dir):
    return R.non_promotional(fx.messages(spark, sf_dir)).select("doc_id", "channel", "content")


DATES_IN = ("2024-01-25", "2024-01-26")


@register("isin_dates", "P11", fx.with_views(
    "SELECT doc_id, strftime(published_at, '%Y-%m-%d') AS published_at FROM articles "
    f"WHERE published_at IN (DATE '{DATES_IN[0]}', DATE '{DATES_IN[1]}')", "articles"))
def isin_dates(spark, sf_dir):
    a = fx.articles(spark, sf_dir).where(F.col("published_at").isin([F.lit(d).cast("date") for d in DATES_IN]))
    return a.select("doc_id", F.date_format("published_at", "yyyy-MM-dd").alias("published_at"))


@register("preview_top5", "P13", fx.with_views(f"""
SELECT origin, doc_id, strftime(published_at, '%Y-%m-%d') AS published_at, title FROM (
  SELECT 'articles' AS origin, doc_id, published_at, title FROM articles
  UNION ALL
  SELECT 'messages', doc_id, published_at, {T.first_sentence_sql('content')} FROM messages WHERE {_NONPROMO})
ORDER BY published_at DESC, origin, doc_id LIMIT 5""", "articles", "messages"))
def preview_top5(spark, sf_dir):
    both = sources_union(spark, sf_dir).drop("content")
    top = both.orderBy(F.col("published_at").desc(), "origin", "doc_id").limit(5)
    return _ingest_out(top)
