"""Registered queries for the text scalar functions (T1..T24, T15/P12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.functions import prompts as P
from inkstream.functions import text as T
from inkstream.functions.dates import as_of_date
from inkstream.plans.registry import register
from inkstream.sources import fixtures as fx
from inkstream.sources.tables import read_table

# Row-wise cleaners run on the `noisy` view (texts carrying every pattern the cleaners look for).
_ROWWISE = {
    "unbold": ("T1", T.unbold, T.unbold_sql),
    "unitalic": ("T2", T.unitalic, T.unitalic_sql),
    "strip_emoji": ("T3", T.strip_emoji, T.strip_emoji_sql),
    "mask_urls": ("T4", T.mask_urls, T.mask_urls_sql),
    "ascii_only": ("T5", T.ascii_only, T.ascii_only_sql),
    "unicode_quotes": ("T6", T.unicode_quotes, T.unicode_quotes_sql),
    "clean_text": ("T7 T8", T.clean_text, T.clean_text_sql),
    "mask_dates": ("T9", T.mask_dates, T.mask_dates_sql),
    "mask_times": ("T10", T.mask_times, T.mask_times_sql),
    "strip_tags": ("T11", T.strip_tags, T.strip_tags_sql),
    "norm_ws": ("T12", T.norm_ws, T.norm_ws_sql),
    "clean_full": ("T13", T.clean_full, T.clean_full_sql),
}


def _rowwise(fn):
    def build(spark, sf_dir):
        return fx.noisy(spark, sf_dir).select("doc_id", fn("text").alias("out"))
    return build


for _key, (_ids, _fn, _sql) in _ROWWISE.items():
    register(_key, _ids, fx.with_views(f"SELECT doc_id, {_sql('text')} AS out FROM noisy", "noisy"))(_rowwise(_fn))


@register("first_sentence", "T14", fx.with_views(
    f"SELECT doc_id, {T.first_sentence_sql('content')} AS title FROM messages", "messages"))
def first_sentence(spark, sf_dir):
    return fx.messages(spark, sf_dir).select("doc_id", T.first_sentence("content").alias("title"))


@register("has_links_flag", "T15 P12 G8", fx.with_views(
    f"SELECT doc_id, {T.has_links_sql('content')} AS has_links FROM messages", "messages"))
def has_links_flag(spark, sf_dir):
    return fx.messages(spark, sf_dir).select("doc_id", T.has_links("content").alias("has_links"))


@register("rows_without_links", "P12", fx.with_views(
    "SELECT doc_id FROM messages WHERE doc_id % 5 <> 0 AND content IS NOT NULL "
    "AND NOT contains(content, 'http') AND NOT contains(content, 'www.')", "messages"))
def rows_without_links(spark, sf_dir):
    m = fx.messages(spark, sf_dir)
    return m.where(F.col("content").isNotNull() & ~T.has_links("content")).select("doc_id")


@register("word_count", "T16", fx.with_views(
    f"SELECT doc_id, {T.word_count_sql('content')} AS n_words FROM articles", "articles"))
def word_count(spark, sf_dir):
    return fx.articles(spark, sf_dir).select("doc_id", T.word_count("content").alias("n_words"))


@register("split_separator", "T18 V6", fx.with_views("""
SELECT doc_id, CAST(pos AS BIGINT) AS variant_no, query FROM (
  SELECT doc_id, UNNEST(range(len(qs))) AS pos, UNNEST(qs) AS query FROM (
    SELECT doc_id, """ + T.split_separator_sql("expansion") + """ AS qs FROM llm_text))""", "llm_text"))
def split_separator(spark, sf_dir):
    lt = fx.llm_text(spark, sf_dir)
    return lt.select("doc_id", F.posexplode(T.split_separator("expansion")).alias("variant_no", "query")) \
        .select("doc_id", F.col("variant_no").cast("bigint"), "query")


@register("join_passages", "T19", fx.with_views(
    f"SELECT conv_id, turn, {T.join_passages_sql('string_split(answer, chr(10))')} AS passages FROM answers",
    "answers"))
def join_passages(spark, sf_dir):
    a = fx.answers(spark, sf_dir)
    return a.select("conv_id", "turn", T.join_passages(F.split("answer", "\n")).alias("passages"))


@register("json_array_extract", "T20", fx.with_views(f"""
SELECT doc_id, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       array_to_string(list_transform(items, lambda x: x.instruction), '|') AS instructions
FROM (SELECT doc_id, {T.json_array_extract_sql('raw')} AS items FROM llm_text)""", "llm_text"))
def json_array_extract(spark, sf_dir):
    lt = fx.llm_text(spark, sf_dir).select("doc_id", T.json_array_extract("raw").alias("items"))
    return lt.select(
        "doc_id",
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.array_join(F.transform("items", lambda x: x["instruction"]), "|").alias("instructions"),
    )


@register("fill_simple_prompt", "T21", fx.with_views(
    f"SELECT conv_id, turn, {P.fill_sql(P.SIMPLE_PROMPT, question='question')} AS prompt FROM answers",
    "answers"))
def fill_simple_prompt(spark, sf_dir):
    a = fx.answers(spark, sf_dir)
    return a.select("conv_id", "turn", P.fill(P.SIMPLE_PROMPT, question=F.col("question")).alias("prompt"))


@register("fill_rag_prompt", "T21", fx.with_views(
    f"SELECT conv_id, turn, {P.fill_sql(P.RAG_PROMPT, question='question', context='answer')} AS prompt "
    f"FROM (SELECT conv_id, turn, answer, CASE WHEN conv_id % 3 = 0 THEN question || ' {{context}} {{question}}' "
    f"ELSE question END AS question FROM answers)", "answers"))
def fill_rag_prompt(spark, sf_dir):
    # every third question holds slot names itself: they must stay as they are
    a = fx.answers(spark, sf_dir).withColumn("question", F.when(
        F.col("conv_id") % 3 == 0, F.concat("question", F.lit(" {context} {question}"))).otherwise(F.col("question")))
    return a.select("conv_id", "turn",
                    P.fill(P.RAG_PROMPT, question=F.col("question"), context=F.col("answer")).alias("prompt"))


@register("norm_unicode_ws", "T12", """
SELECT doc_id, lang || ' a b ' || CAST(doc_id AS VARCHAR) || ' c' AS out FROM documents""")
def norm_unicode_ws(spark, sf_dir):
    """Runs of spaces of every kind inside and at the edges of a text."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "lang")
    odd = F.concat(F.lit("\u00a0\x0b"), "lang", F.lit("\u2003 \u2028a\u00a0b\x1c\n"), F.col("doc_id").cast("string"), F.lit("\u3000c\x85 "))
    return d.select("doc_id", T.norm_ws(odd).alias("out"))


_PROMPT_KINDS = {
    "expansion": (P.EXPANSION_PROMPT, {"n_expansions": ("3", None), "separator": (P.QUESTION_SEPARATOR, None), "question": (None, "question")}),
    "rerank": (P.RERANK_PROMPT, {"keep_top_k": ("3", None), "separator": (P.PASSAGE_SEPARATOR, None), "question": (None, "question"),
                                 "passages": (None, "answer")}),
    "question_answer": (P.QA_PROMPT, {"user_query": (None, "question"), "context": (None, "answer")}),
    "evaluation": (P.EVALUATION_PROMPT, {"query": (None, "question"), "output": (None, "answer")}),
}


def _replaced_sql(template: str, slots: dict) -> str:
    """Fills by nested replace(): equal to one pass as long as no value holds a slot name."""
    out = T._q(template)
    for name, (value, col) in slots.items():
        out = f"replace({out}, '{{{name}}}', {T._q(value) if col is None else f"coalesce({col}, '')"})"
    return out


@register("fill_prompt_kinds", "T21", fx.with_views(" UNION ALL ".join(
    f"SELECT conv_id, turn, '{k}' AS kind, {_replaced_sql(t, s)} AS prompt FROM answers"
    for k, (t, s) in _PROMPT_KINDS.items()), "answers"))
def fill_prompt_kinds(spark, sf_dir):
    a = fx.answers(spark, sf_dir)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), P.fill(t, **{
        n: F.lit(v) if c is None else F.col(c) for n, (v, c) in s.items()}).alias("prompt"))
        for k, (t, s) in _PROMPT_KINDS.items()])
    return a.select("conv_id", "turn", F.inline(kinds))


# ----------------------------------------------------------------------------- T22
# Injected question endings (keyed by item_id % 5) and currency aliases.
QUESTION_ENDINGS = (
    " Good news about ethereum today",
    " What is the price of btc yesterday?",
    " Are there good news about bitcoin 3 days ago?",
    " Regulatory news on 2024-05-06",
    "",
)
CURRENCY_ALIASES = {
    "bitcoin": "BTC", "btc": "BTC",
    "ethereum": "ETH", "ether": "ETH", "eth": "ETH",
    "solana": "SOL", "sol": "SOL",
    "ripple": "XRP", "xrp": "XRP",
    "cardano": "ADA", "ada": "ADA",
    "dogecoin": "DOGE", "doge": "DOGE",
}
AS_OF = "2024-07-26"
_ALIAS_RE = "(?:^|[^a-z0-9])(" + "|".join(CURRENCY_ALIASES) + ")(?:[^a-z0-9]|$)"
_ISO_RE = r"(\d{4}-\d{2}-\d{2})"
_AGO_RE = r"(\d+) days? ago"
_YESTERDAY_RE = "(?:^|[^a-z])yesterday(?:[^a-z]|$)"
_TODAY_RE = "(?:^|[^a-z])today(?:[^a-z]|$)"


def questions(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    ending = F.element_at(F.array(*[F.lit(s) for s in QUESTION_ENDINGS]), (F.col("item_id") % 5 + 1).cast("int"))
    return b.select("item_id", F.concat("text", ending).alias("question"))


def _questions_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(QUESTION_ENDINGS))
    return f"SELECT item_id, concat(text, CASE item_id % 5 {cases} END) AS question FROM benchmark"


def query_metadata_cols(question, as_of: str = AS_OF):
    q = F.lower(question)
    alias = F.regexp_extract(q, _ALIAS_RE, 1)
    currency = F.lit(None).cast("string")
    for a, sym in reversed(list(CURRENCY_ALIASES.items())):
        currency = F.when(alias == a, F.lit(sym)).otherwise(currency)
    base = as_of_date(as_of)
    iso = F.regexp_extract(q, _ISO_RE, 1)
    ago = F.regexp_extract(q, _AGO_RE, 1)
    date = (F.when(iso != "", F.try_to_date(iso, "yyyy-MM-dd"))
            .when(ago != "", F.date_sub(base, ago.try_cast("int")))
            .when(q.rlike(_YESTERDAY_RE), F.date_sub(base, 1))
            .when(q.rlike(_TODAY_RE), base))
    return currency.alias("currency"), F.date_format(date, "yyyy-MM-dd").alias("date")


def _query_metadata_sql(as_of: str = AS_OF) -> str:
    q = "lower(question)"
    alias = f"regexp_extract({q}, '{_ALIAS_RE}', 1)"
    cur = "CASE " + " ".join(f"WHEN {alias} = '{a}' THEN '{s}'" for a, s in CURRENCY_ALIASES.items()) + " END"
    iso = f"regexp_extract({q}, '{_ISO_RE}', 1)"
    ago = f"regexp_extract({q}, '{_AGO_RE}', 1)"
    base = f"DATE '{as_of}'"
    date = (f"CASE WHEN {iso} <> '' THEN TRY_CAST({iso} AS DATE) "
            f"WHEN {ago} <> '' THEN {base} - CAST({ago} AS INTEGER) "
            f"WHEN regexp_matches({q}, '{_YESTERDAY_RE}') THEN {base} - 1 "
            f"WHEN regexp_matches({q}, '{_TODAY_RE}') THEN {base} END")
    return (f"SELECT item_id, {cur} AS currency, strftime({date}, '%Y-%m-%d') AS date FROM questions")


@register("query_metadata", "T22", fx.with_views(_query_metadata_sql(), extra={"questions": _questions_sql()}))
def query_metadata(spark, sf_dir):
    return questions(spark, sf_dir).select("item_id", *query_metadata_cols(F.col("question")))


@register("eval_scores", "T23", fx.with_views(
    "SELECT doc_id, " + ", ".join(f"{T.eval_score_sql('grade', c)} AS {c.lower()}" for c in T.EVAL_CRITERIA)
    + " FROM llm_text", "llm_text"))
def eval_scores(spark, sf_dir):
    lt = fx.llm_text(spark, sf_dir)
    return lt.select("doc_id", *[T.eval_score("grade", c).alias(c.lower()) for c in T.EVAL_CRITERIA])


@register("split_lines", "T24", fx.with_views(f"""
SELECT conv_id, turn, CAST(pos AS BIGINT) AS line_no, line FROM (
  SELECT conv_id, turn, UNNEST(range(len(ls))) AS pos, UNNEST(ls) AS line FROM (
    SELECT conv_id, turn, {T.split_lines_sql('answer')} AS ls FROM answers))""", "answers"))
def split_lines(spark, sf_dir):
    a = fx.answers(spark, sf_dir)
    return a.select("conv_id", "turn", F.posexplode(T.split_lines("answer")).alias("line_no", "line")) \
        .select("conv_id", "turn", F.col("line_no").cast("bigint"), "line")
