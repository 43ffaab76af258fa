"""Registered queries for the instruction-dataset build (G1..G5, T17, T20, P14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.functions import prompts as P
from inkstream.functions import text as T
from inkstream.operators import dataset as G
from inkstream.operators.chunking import tokens_of, tokens_sql
from inkstream.plans.q_chunks import CLEANED_SQL, cleaned_articles
from inkstream.operators.indexing import index_within
from inkstream.plans.registry import register
from inkstream.session import materialize
from inkstream.sources import fixtures as fx

BATCH = 3


def _contents(spark, sf_dir):
    """P10: non-empty cleaned contents. The cleaned text is written once to the shared folder and the
    emptiness test runs on the written column: filtered in place, Catalyst would push the predicate
    below the projection and evaluate the whole cleaning chain twice per row."""
    c = materialize(cleaned_articles(spark, sf_dir).select("source", "doc_id", "cleaned_content"), "cleaned-contents")
    return c.where(F.length("cleaned_content") > 0)


_IDX_SQL = ("SELECT source, doc_id, cleaned_content, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx "
            "FROM cleaned WHERE length(cleaned_content) > 0")


@register("prompt_batches", "G2 T17", fx.with_views(f"""
SELECT source, CAST(floor(idx / {BATCH}) AS BIGINT) AS batch_no, min(idx) AS start_index, count(*) AS n_items,
       substring({T._q(P.DATASET_USER_PROMPT)} || replace({T._q(P.DATASET_COUNT_LINE)}, '{{n}}', CAST(count(*) AS VARCHAR))
                 || {T._q(P.DATASET_CONTENTS_HEADER)}
                 || string_agg('Content number ' || CAST(idx AS VARCHAR) || chr(10) || cleaned_content || chr(10), ''
                               ORDER BY idx), 1, {T.PROMPT_MAX_CHARS}) AS prompt,
       CAST(sum(length('Content number ' || CAST(idx AS VARCHAR) || chr(10) || cleaned_content || chr(10)))
            + length({T._q(P.DATASET_USER_PROMPT)}) + length({T._q(P.DATASET_COUNT_LINE)}) - 3
            + length(CAST(count(*) AS VARCHAR)) + length({T._q(P.DATASET_CONTENTS_HEADER)}) AS BIGINT) AS full_chars
FROM idx GROUP BY source, floor(idx / {BATCH})""", "articles", extra={"cleaned": CLEANED_SQL, "idx": _IDX_SQL}))
def prompt_batches(spark, sf_dir):
    return G.prompt_batches(_contents(spark, sf_dir), "source", "doc_id", "cleaned_content", BATCH)


def aligned(spark, sf_dir):
    """Batches of one content (the reference's batch size) aligned with the model's JSON answers."""
    batches = _contents(spark, sf_dir).select("doc_id", F.lit(0).cast("bigint").alias("pos"), "cleaned_content")
    return G.align_batch_results(batches, fx.llm_text(spark, sf_dir).select("doc_id", "raw"), "doc_id",
                                 "cleaned_content")


_ALIGNED_SQL = (f"SELECT l.doc_id, CAST(0 AS BIGINT) AS pos, items[1].instruction AS instruction, "
                f"c.cleaned_content AS content FROM (SELECT doc_id, {T.json_array_extract_sql('raw')} AS items "
                f"FROM llm_text) l JOIN cleaned c ON c.doc_id = l.doc_id "
                f"WHERE length(c.cleaned_content) > 0 AND coalesce(len(items), 0) = 1")


@register("align_batch_results", "G3 T20", fx.with_views(
    "SELECT doc_id, pos, instruction, content FROM aligned", "articles", "llm_text",
    extra={"cleaned": CLEANED_SQL, "aligned": _ALIGNED_SQL}))
def align_batch_results(spark, sf_dir):
    return aligned(spark, sf_dir).select("doc_id", "pos", "instruction", "content")


# Answers to batches of three: item i of a batch says "item i"; every fourth batch of a source answers one
# item too few, and is dropped whole.
SHORT_EVERY = 4


@register("align_batches_of_three", "G3", fx.with_views(f"""
SELECT source || '#' || (idx // {BATCH}) AS batch, CAST(idx % {BATCH} AS BIGINT) AS pos,
       'item ' || (idx % {BATCH}) || ' of ' || source || '#' || (idx // {BATCH}) AS instruction, cleaned_content AS content
FROM idx WHERE (idx // {BATCH}) % {SHORT_EVERY} <> 0""", "articles", extra={"cleaned": CLEANED_SQL, "idx": _IDX_SQL}))
def align_batches_of_three(spark, sf_dir):
    c = index_within(_contents(spark, sf_dir), ["source"], ["doc_id"])
    no = F.floor(F.col("idx") / BATCH).cast("bigint")
    c = c.select(F.concat("source", F.lit("#"), no.cast("string")).alias("batch"), no.alias("batch_no"),
                 (F.col("idx") % BATCH).cast("bigint").alias("pos"), "cleaned_content")
    n = c.groupBy("batch", "batch_no").agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("n", F.col("n") - (F.col("batch_no") % SHORT_EVERY == 0).cast("int"))
    item = lambda i: F.struct(F.concat(F.lit("item "), i.cast("string"), F.lit(" of "), F.col("batch")).alias("instruction"),
                              i.cast("string").alias("content"))
    items = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), item))
    raw = F.concat(F.lit("Sure: "), F.coalesce(F.to_json(items), F.lit("[]")), F.lit(" end"))
    return G.align_batch_results(c, n.select("batch", raw.alias("raw")), "batch", "cleaned_content").select(
        "batch", "pos", "instruction", "content")


@register("train_val_split", "G4", fx.with_views(
    f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {G.key_hash_sql('doc_id')}, CAST(doc_id AS VARCHAR)) <= "
    f"(SELECT (count(*) * {G.TRAIN_PERCENT} + 50) // 100 FROM aligned) THEN 'train' ELSE 'validation' END "
    f"AS split FROM aligned", "articles", "llm_text", extra={"cleaned": CLEANED_SQL, "aligned": _ALIGNED_SQL}))
def train_val_split(spark, sf_dir):
    return G.train_val_split(aligned(spark, sf_dir), "doc_id").select("doc_id", "split")


def _ids_sql() -> str:
    prompt = P.fill_sql(P.INSTRUCT_SAMPLE, instruction="instruction", content="content")
    return f"list_concat([{G.BOS_ID}], {G.token_ids_sql(prompt)})"


@register("tokenize_pad", "G5 P14 D14", fx.with_views(f"""
SELECT doc_id, CAST(least(len(ids), {G.MAX_TOKENS}) AS INTEGER) AS n_real, CAST({G.MAX_TOKENS} AS INTEGER) AS n_ids,
       md5(array_to_string(list_concat(ids[1:{G.MAX_TOKENS}], list_resize(CAST([] AS INTEGER[]), greatest({G.MAX_TOKENS} - len(ids), 0), {G.PAD_ID})), ',')) AS ids_md5,
       md5(array_to_string(list_concat(ids[1:{G.MAX_TOKENS}], list_resize(CAST([] AS INTEGER[]), greatest({G.MAX_TOKENS} - len(ids), 0), {G.PAD_ID})), ',')) AS labels_md5,
       md5(repeat('1', least(len(ids), {G.MAX_TOKENS})::INT) || repeat('0', greatest({G.MAX_TOKENS} - len(ids), 0)::INT)) AS mask_md5,
       CAST(len(ids) AS BIGINT) AS full_tokens
FROM (SELECT doc_id, {_ids_sql()} AS ids FROM aligned)""", "articles", "llm_text",
    extra={"cleaned": CLEANED_SQL, "aligned": _ALIGNED_SQL}))
def tokenize_pad(spark, sf_dir):
    t = G.tokenize_pad(aligned(spark, sf_dir).select("doc_id", "instruction", "content"))
    return t.select("doc_id", "n_real", F.size("input_ids").alias("n_ids"),
                    F.md5(F.array_join("input_ids", ",")).alias("ids_md5"),
                    F.md5(F.array_join("labels", ",")).alias("labels_md5"),
                    F.md5(F.array_join("attention_mask", "")).alias("mask_md5"), "full_tokens")


@register("pack_by_budget", "G1", fx.with_views(f"""
SELECT strftime(published_at, '%Y-%m-%d') AS published_at, CAST(floor(cb / {G.PACK_BUDGET}) AS BIGINT) AS pack_no,
       count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens, min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM (SELECT published_at, doc_id, n_tokens,
             coalesce(sum(n_tokens) OVER (PARTITION BY published_at ORDER BY doc_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb
      FROM (SELECT published_at, doc_id, len({tokens_sql('content')}) AS n_tokens FROM articles))
GROUP BY published_at, floor(cb / {G.PACK_BUDGET})""", "articles"))
def pack_by_budget(spark, sf_dir):
    a = fx.articles(spark, sf_dir).select(F.date_format("published_at", "yyyy-MM-dd").alias("published_at"), "doc_id",
                                          F.size(tokens_of("content")).cast("bigint").alias("n_tokens"))
    p = G.pack_by_budget(a, "published_at", "doc_id", "n_tokens")
    return p.groupBy("published_at", "pack_no").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").cast("bigint").alias("n_tokens"),
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))


_NEXT_FIT_SQL = f"""
SELECT strftime(published_at, '%Y-%m-%d') AS published_at, pack_no, count(*) AS n_docs,
       CAST(sum(n_tokens) AS BIGINT) AS n_tokens, min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM pk GROUP BY published_at, pack_no"""
NEXT_FIT_CTES = {
    "d": f"SELECT published_at, doc_id, CAST(len({tokens_sql('content')}) AS BIGINT) AS n_tokens, "
         f"row_number() OVER (PARTITION BY published_at ORDER BY doc_id) AS rn FROM articles",
    "pk": f"""SELECT published_at, rn, doc_id, n_tokens, CAST(0 AS BIGINT) AS pack_no, n_tokens AS load FROM d WHERE rn = 1
  UNION ALL
  SELECT d.published_at, d.rn, d.doc_id, d.n_tokens,
         CASE WHEN pk.load + d.n_tokens > {G.PACK_BUDGET} THEN pk.pack_no + 1 ELSE pk.pack_no END,
         CASE WHEN pk.load + d.n_tokens > {G.PACK_BUDGET} THEN d.n_tokens ELSE pk.load + d.n_tokens END
  FROM pk JOIN d ON d.published_at = pk.published_at AND d.rn = pk.rn + 1""",
}


@register("pack_next_fit", "G1", fx.with_views(_NEXT_FIT_SQL, "articles", extra=NEXT_FIT_CTES, recursive=True))
def pack_next_fit(spark, sf_dir):
    a = fx.articles(spark, sf_dir).select(F.date_format("published_at", "yyyy-MM-dd").alias("published_at"), "doc_id",
                                          F.size(tokens_of("content")).cast("bigint").alias("n_tokens"))
    p = G.pack_next_fit(a, "published_at", "doc_id", "n_tokens")
    return p.groupBy("published_at", "pack_no").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").cast("bigint").alias("n_tokens"),
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
