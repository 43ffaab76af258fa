"""Record-level operators: change-event flattening, dispatch, validation, routing, filters and
per-channel feeds (S3, S11..S13, S15, P1..P3, P7..P9, P11, P13, K4, R6).

All are narrow transformations (no shuffle) except the per-channel limits, which are
``row_number() <= n`` windows that Spark plans with a partial WindowGroupLimit per map task,
so a hot channel sends only n rows per task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkstream.functions.dates import as_of_date, parse_date
from inkstream.functions.text import first_sentence, has_links

ARTICLE_COLS = ("entry_id", "type", "source", "title", "content", "summary", "published_at")
REQUIRED = ("entry_id", "source", "title", "content")
ACCEPTED_TYPE = "articles"      # input type of raw messages
CLEANED_TYPE = "article"        # type after cleaning
# Target collections per cleaned record type (K4).
CLEAN_TARGETS = {"article": "cleaned_articles"}
VECTOR_TARGETS = {"article": "vector_articles"}
QUARANTINE = "quarantine"


def insert_only(envelopes: DataFrame) -> DataFrame:
    """S3: keep insert events of the change feed."""
    return envelopes.where(F.col("operationType") == "insert")


def flatten_change(envelopes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """fullDocument fields + entry_id (string of _id) + type (= collection); _id dropped."""
    doc_fields = [f.name for f in envelopes.schema["fullDocument"].dataType.fields if f.name != "_id"]
    return envelopes.select(
        *keep,
        F.col("fullDocument._id").cast("string").alias("entry_id"),
        F.col("ns.coll").alias("type"),
        *[F.col(f"fullDocument.{f}").alias(f) for f in doc_fields],
    )


def dispatch(raw: DataFrame) -> DataFrame:
    """Status per row; only 'articles' continue, other types go to quarantine with a reason."""
    return raw.withColumn("reason", F.when(F.col("type") == ACCEPTED_TYPE, F.lit(None).cast("string"))
                          .otherwise(F.concat(F.lit("unsupported type: "), F.coalesce("type", F.lit("null")))))


def validate(raw: DataFrame, as_of: str) -> DataFrame:
    """Reason is null for valid rows; a missing published_at defaults to ``as_of``."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]
    reason = F.when(F.size(F.array_compact(F.array(*missing))) > 0,
                    F.concat(F.lit("missing: "), F.array_join(F.array_compact(F.array(*missing)), ",")))
    return raw.withColumn("reason", reason).withColumn(
        "published_at", F.coalesce(F.col("published_at"), F.date_format(as_of_date(as_of), "yyyy-MM-dd")))


def route(df: DataFrame, targets: dict[str, str], type_col: str = "type") -> Column:
    """K4: target table per row (not per batch); unknown type -> quarantine."""
    out = F.lit(QUARANTINE)
    for t, target in targets.items():
        out = F.when(F.col(type_col) == t, F.lit(target)).otherwise(out)
    return out


def date_range(df: DataFrame, lower: str, upper: str, col: str = "published_at") -> DataFrame:
    """Inclusive range on a DATE column (pushed to the Parquet scan / partition pruning)."""
    return df.where(F.col(col).between(F.lit(lower).cast("date"), F.lit(upper).cast("date")))


def ingest_bounds(mode: str, as_of: str) -> tuple[str, str]:
    """Job argument -> inclusive date bounds. daily = as_of only, backfill = 360 days back."""
    import datetime as dt
    day = dt.date.fromisoformat(as_of)
    if mode == "daily":
        return as_of, as_of
    if mode == "backfill":
        return (day - dt.timedelta(days=360)).isoformat(), as_of
    raise ValueError(f"mode {mode} not valid")


def non_promotional(messages: DataFrame, col: str = "content") -> DataFrame:
    """Drop null and link-bearing messages."""
    return messages.where(F.col(col).isNotNull() & ~has_links(col))


def messages_as_articles(messages: DataFrame) -> DataFrame:
    """Channel messages in the article shape (source = channel id, title = first sentence)."""
    return messages.select(
        F.md5(F.concat_ws(":", "channel", F.col("doc_id").cast("string"))).alias("entry_id"),
        F.lit(ACCEPTED_TYPE).alias("type"), F.col("channel").alias("source"),
        first_sentence("content").alias("title"), "content", F.lit(None).cast("string").alias("summary"),
        "published_at", "doc_id")


def latest_per_channel(messages: DataFrame, n: int, since: str | None = None) -> DataFrame:
    """S11 (newest n per channel) or, with ``since``, S12 (first n per channel from that day on)."""
    m = non_promotional(messages)
    if since is None:
        order = [F.col("published_at").desc(), F.col("doc_id").desc()]
    else:
        m = m.where(F.col("published_at") >= F.lit(since).cast("date"))
        order = [F.col("published_at").asc(), F.col("doc_id").asc()]
    w = Window.partitionBy("channel").orderBy(*order)
    return m.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)


API_ARTICLE_SCHEMA = ("struct<status:string,page:bigint,articles:array<struct<publishedAt:string,"
                      "title:string,content:string,description:string,language:string>>>")


def api_responses(articles: DataFrame, page_size: int = 100) -> DataFrame:
    """Landing form of S13: one JSON response per page of ``page_size`` records (bounded groups)."""
    rec = F.struct(
        F.date_format("published_at", "yyyy-MM-dd'T'10:00:00'Z'").alias("publishedAt"),
        "title", "content", F.col("source").alias("description"), F.col("lang").alias("language"))
    pages = articles.groupBy(F.floor(F.col("doc_id") / page_size).cast("bigint").alias("page")).agg(
        F.collect_list(rec).alias("articles"))
    return pages.select(F.to_json(F.struct(F.lit("ok").alias("status"), "page", "articles")).alias("body"))


def api_records_to_articles(responses: DataFrame, language: str, start: str, end: str,
                            page: int | None = None) -> DataFrame:
    """Response JSON -> article rows (publishedAt -> published_at, description -> summary,
    constant source), with the language, inclusive date-range and page arguments applied (no page:
    all pages)."""
    r = responses.select(F.from_json("body", API_ARTICLE_SCHEMA).alias("r"))
    if page is not None:
        r = r.where(F.col("r.page") == page)
    a = r.select(F.col("r.page").alias("page"), F.explode("r.articles").alias("a"))
    out = a.select(
        F.lit("news_api").alias("source"), parse_date("a.publishedAt").alias("published_at"),
        F.col("a.title").alias("title"), F.col("a.content").alias("content"),
        F.col("a.description").alias("summary"), F.col("a.language").alias("language"))
    return out.where((F.col("language") == language) & F.col("published_at").between(start, end))


def frame_to_documents(df: DataFrame, text_col: str) -> DataFrame:
    """The chosen text column becomes page_content; all other columns go into metadata."""
    others = [c for c in df.columns if c != text_col]
    return df.select(F.col(text_col).alias("page_content"), F.struct(*others).alias("metadata"))
