"""Registered queries for vector search and the question -> context -> prompt plan
(V2..V8, A5, T25, T21, P16, P17, U2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkstream.functions import prompts as P
from inkstream.functions import text as T
from inkstream.operators import embedding as E
from inkstream.operators import search as S
from inkstream.plans.q_chunks import article_chunks, chunks_sql_ctes
from inkstream.plans.q_text import _questions_sql, questions
from inkstream.plans.registry import register
from inkstream.sources import fixtures as fx
from inkstream.session import materialize
from inkstream.sources.tables import read_table

TOP_K = 10            # hits per question; each variant contributes k // 3
KEEP_TOP_K = 3        # passages kept by the reranker
MERGED_TOP = 5        # merged, de-duplicated hits per question
EMBED_DIM = 64        # size of the given `embeddings` vectors

# ----------------------------------------------------------------------------- on `embeddings`
_DOT = ("list_sum(list_transform(range(1, len(q.q) + 1), "
        "lambda i: CAST(q.q[i] AS DOUBLE) * CAST(e.embedding[i] AS DOUBLE)))")
_QN = "sqrt(list_sum(list_transform(q.q, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
_EN = "sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
_SCORED = {"scored": f"SELECT q.query_id, q.variant_no, e.vec_id, round({_DOT} / ({_QN} * {_EN}), 9) AS score "
                     f"FROM queries_v q, embeddings e"}
_RANKED = {"ranked": "SELECT *, row_number() OVER (PARTITION BY query_id, variant_no ORDER BY score DESC, vec_id) "
                     "AS rank FROM scored"}


def _emb_hits(spark, sf_dir, k):
    corpus = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return S.topk_search(corpus, fx.queries_v(spark, sf_dir), k, corpus_id="vec_id", corpus_vec="embedding",
                         query_keys=["query_id", "variant_no"], query_vec="q")


@register("vector_topk", "V2 D12", fx.with_views(
    "SELECT query_id, variant_no, rank, vec_id, score FROM ranked "
    "WHERE query_id < 0 AND rank <= 10", "queries_v", extra={**_SCORED, **_RANKED}))
def vector_topk(spark, sf_dir):
    """Every row with vec_id % 100 = 0 against all rows."""
    corpus = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    rows = fx.queries_v(spark, sf_dir).where(F.col("query_id") < 0)
    return S.topk_search(corpus, rows, 10, corpus_id="vec_id", corpus_vec="embedding",
                         query_keys=["query_id", "variant_no"], query_vec="q")


@register("multi_query_topk", "V3", fx.with_views(
    f"SELECT query_id, variant_no, rank, vec_id, score FROM ranked WHERE rank <= {TOP_K // 3}",
    "queries_v", extra={**_SCORED, **_RANKED}))
def multi_query_topk(spark, sf_dir):
    return _emb_hits(spark, sf_dir, TOP_K // 3)


@register("filtered_topk", "P17", fx.with_views(f"""
SELECT query_id, variant_no, rank, vec_id, score FROM (
  SELECT s.*, row_number() OVER (PARTITION BY query_id, variant_no ORDER BY score DESC, s.vec_id) AS rank
  FROM scored s JOIN embeddings e USING (vec_id) WHERE e.label % 2 = 1) WHERE rank <= {TOP_K // 3}""", "queries_v", extra=_SCORED))
def filtered_topk(spark, sf_dir):
    """A search among the rows that the caller's predicate keeps."""
    corpus = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return S.topk_search(corpus, fx.queries_v(spark, sf_dir), TOP_K // 3, corpus_id="vec_id", corpus_vec="embedding",
                         query_keys=["query_id", "variant_no"], query_vec="q", predicate=F.col("label") % 2 == 1)


@register("merge_dedup_top5", "V4", fx.with_views(f"""
SELECT query_id, vec_id, score, rank FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM (SELECT query_id, vec_id, max(score) AS score FROM ranked WHERE rank <= {TOP_K // 3} GROUP BY query_id, vec_id))
WHERE rank <= {MERGED_TOP}""", "queries_v", extra={**_SCORED, **_RANKED}))
def merge_dedup_top5(spark, sf_dir):
    return S.merge_dedup_topk(_emb_hits(spark, sf_dir, TOP_K // 3), "query_id", "vec_id", MERGED_TOP) \
        .select("query_id", "vec_id", "score", "rank")


@register("flatten_hits", "A5", fx.with_views(f"""
SELECT query_id, array_to_string(list(vec_id ORDER BY variant_no, rank), ',') AS hit_ids,
       CAST(count(*) AS BIGINT) AS n_hits
FROM ranked WHERE rank <= {TOP_K // 3} GROUP BY query_id""", "queries_v", extra={**_SCORED, **_RANKED}))
def flatten_hits(spark, sf_dir):
    f = S.flatten_hits(_emb_hits(spark, sf_dir, TOP_K // 3), "query_id", "variant_no", "vec_id")
    return f.select("query_id", F.array_join("hit_ids", ",").alias("hit_ids"),
                    F.size("hit_ids").cast("bigint").alias("n_hits"))


@register("vector_size_check", "V8", f"""
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim, len(embedding) = {EMBED_DIM} AS accepted FROM embeddings""")
def vector_size_check(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return S.vector_size_check(e, "embedding", EMBED_DIM).select("vec_id", "dim", "accepted")


def _load_length_model():
    """A deterministic stand-in for a user's model: digits are counted, a text with "the" fails."""
    def encode(texts):
        if any(" the " in t for t in texts):
            raise ValueError("cannot encode this text")
        return [[float(len(t)), float(t.count(" "))] for t in texts]
    return encode


@register("model_embed", "V9", """
SELECT doc_id, CASE WHEN text LIKE '% the %' THEN 0 ELSE 2 END AS dim,
       CASE WHEN text NOT LIKE '% the %' THEN CAST(length(text) AS DOUBLE) END AS v0,
       CASE WHEN text NOT LIKE '% the %' THEN CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) END AS v1
FROM documents""")
def model_embed(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    v = d.select("doc_id", E.model_embedder(_load_length_model, 2)("text").alias("v"))
    return v.select("doc_id", F.size("v").alias("dim"), F.try_element_at("v", F.lit(1)).cast("double").alias("v0"),
                    F.try_element_at("v", F.lit(2)).cast("double").alias("v1"))


_LSH_SQL = f"""
WITH queries_v AS ({fx.SQL_VIEWS["queries_v"]}),
bits AS (SELECT CAST(greatest(2, ceil(log2(count(*) / {S.LSH_BUCKET}.0))) AS INT) AS n FROM embeddings),
planes AS (SELECT t, b, list(CASE WHEN md5('42:' || t || ':' || b || ':' || i) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY i) AS p
  FROM range({S.LSH_TABLES}) a(t), (SELECT unnest(range((SELECT n FROM bits))) AS b), range({EMBED_DIM}) c(i) GROUP BY t, b),
cc AS (SELECT vec_id, t, sum(CASE WHEN list_inner_product(CAST(embedding AS DOUBLE[]), p) > 0 THEN 1 << b ELSE 0 END) AS code
  FROM embeddings, planes GROUP BY vec_id, t),
qc AS (SELECT query_id, variant_no, t, sum(CASE WHEN list_inner_product(q, p) > 0 THEN 1 << b ELSE 0 END) AS code
  FROM queries_v, planes GROUP BY query_id, variant_no, t),
cand AS (SELECT DISTINCT query_id, variant_no, vec_id FROM qc JOIN cc ON qc.t = cc.t
  AND bit_count(xor(qc.code::BIGINT, cc.code::BIGINT)) <= 1),
scored AS (SELECT c.query_id, c.variant_no, c.vec_id, round({_DOT} / ({_QN} * {_EN}), 9) AS score
  FROM cand c JOIN queries_v q ON q.query_id = c.query_id AND q.variant_no = c.variant_no JOIN embeddings e ON e.vec_id = c.vec_id)
SELECT query_id, variant_no, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, variant_no ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= {TOP_K // 3}"""


@register("lsh_topk", "V7", _LSH_SQL)
def lsh_topk(spark, sf_dir):
    corpus = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return S.lsh_topk(corpus, fx.queries_v(spark, sf_dir), TOP_K // 3, corpus_id="vec_id", corpus_vec="embedding",
                      query_keys=["query_id", "variant_no"], query_vec="q", dim=EMBED_DIM)


# ----------------------------------------------------------------------------- text plan
# V6 re-aimed: three deterministic variants of each question (whole, first sentence, last sentence).
def question_variants(spark, sf_dir):
    q = questions(spark, sf_dir)
    pieces = F.filter(F.split("question", "[.!?]"), lambda x: F.trim(x) != "")
    v = F.array(F.col("question"), T.first_sentence("question"), F.element_at(pieces, -1))
    return q.select("item_id", "question", F.posexplode(v).alias("variant_no", "query_text")) \
        .select("item_id", "question", F.col("variant_no").cast("bigint"), "query_text")


VARIANTS_SQL = ("SELECT item_id, question, CAST(pos AS BIGINT) AS variant_no, qt AS query_text FROM ("
                "SELECT item_id, question, UNNEST([0, 1, 2]) AS pos, UNNEST([question, "
                f"{T.first_sentence_sql('question')}, "
                "list_filter(regexp_split_to_array(question, '[.!?]'), lambda x: trim(x) <> '')[-1]]) AS qt "
                "FROM questions)")


def chunk_vectors(spark, sf_dir, predicate=None):
    ch = article_chunks(spark, sf_dir)
    if predicate is not None:
        ch = ch.where(predicate)
    u = ch.groupBy("chunk_id").agg(F.first("chunk_content").alias("chunk_content"),
                                   F.min("published_at").alias("published_at"))
    return u.select("chunk_id", "chunk_content", "published_at", E.hash_embed("chunk_content").alias("vec"))


def text_hits(spark, sf_dir, predicate=None, corpus_cols=()):
    qv = question_variants(spark, sf_dir).select("item_id", "variant_no", E.hash_embed("query_text").alias("qv"))
    return S.topk_search(chunk_vectors(spark, sf_dir, predicate), qv, TOP_K // 3, corpus_id="chunk_id",
                         corpus_vec="vec", query_keys=["item_id", "variant_no"], query_vec="qv",
                         corpus_cols=corpus_cols)


def _sparse(src: str, keys: str, text: str) -> str:
    return (f"SELECT {keys}, b, CAST(sum(sg) AS DOUBLE) AS c FROM (SELECT {keys}, "
            f"{E.token_bucket_sql('t', E.EMBED_DIM)} AS b, {E.token_sign_sql('t')} AS sg FROM {src}, "
            f"UNNEST({E.words_sql(text)}) AS u(t)) GROUP BY {keys}, b HAVING sum(sg) <> 0")


def text_ctes(date_filter: str | None = None) -> dict:
    where = f"WHERE published_at = '{date_filter}'" if date_filter else ""
    ctes = dict(chunks_sql_ctes())
    ctes.update({
        "questions": _questions_sql(),
        "variants": VARIANTS_SQL,
        "uchunks": f"SELECT chunk_id, first(chunk_content) AS chunk_content FROM chunks {where} GROUP BY chunk_id",
        "cvec": _sparse("uchunks", "chunk_id", "chunk_content"),
        "cnorm": "SELECT chunk_id, sqrt(sum(c * c)) AS n FROM cvec GROUP BY chunk_id",
        "qvec": _sparse("variants", "item_id, variant_no", "query_text"),
        "qnorm": "SELECT item_id, variant_no, sqrt(sum(c * c)) AS n FROM qvec GROUP BY item_id, variant_no",
        "dots": "SELECT q.item_id, q.variant_no, d.chunk_id, sum(q.c * d.c) AS dt FROM qvec q JOIN cvec d "
                "ON q.b = d.b GROUP BY q.item_id, q.variant_no, d.chunk_id",
        "tscored": "SELECT qn.item_id, qn.variant_no, cn.chunk_id, round(coalesce(dt, 0) / (qn.n * cn.n), 9) AS score "
                   "FROM qnorm qn CROSS JOIN cnorm cn LEFT JOIN dots d ON d.item_id = qn.item_id "
                   "AND d.variant_no = qn.variant_no AND d.chunk_id = cn.chunk_id",
        "thits": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id, variant_no ORDER BY score DESC, "
                 f"chunk_id) AS rank FROM tscored) WHERE rank <= {TOP_K // 3}",
        "tmerged": f"SELECT * FROM (SELECT item_id, chunk_id, score, row_number() OVER (PARTITION BY item_id ORDER BY "
                   f"score DESC, chunk_id) AS rank FROM (SELECT item_id, chunk_id, max(score) AS score FROM thits "
                   f"GROUP BY item_id, chunk_id)) WHERE rank <= {MERGED_TOP}",
    })
    return ctes


def _bm25_sql() -> str:
    w = E.words_sql("u.chunk_content")
    return f"""
SELECT item_id, chunk_id, bm25, rank FROM (
  SELECT item_id, chunk_id, bm25, row_number() OVER (PARTITION BY item_id ORDER BY bm25 DESC, chunk_id) AS rank FROM (
    SELECT m.item_id, m.chunk_id, round(coalesce(s.s, 0), 9) AS bm25 FROM tmerged m LEFT JOIN (
      SELECT item_id, chunk_id, sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * {S.BM25_K1 + 1}
             / (tf + {S.BM25_K1} * (1 - {S.BM25_B} + {S.BM25_B} * dl / avgdl))) AS s
      FROM (SELECT t.*, count(*) OVER (PARTITION BY t.item_id, t.term) AS df FROM (
              SELECT d.item_id, d.chunk_id, d.dl, d.term, count(*) AS tf FROM (
                SELECT m.item_id, m.chunk_id, len({w}) AS dl, UNNEST({w}) AS term
                FROM tmerged m JOIN uchunks u ON u.chunk_id = m.chunk_id) d
              SEMI JOIN (SELECT DISTINCT item_id, UNNEST({E.words_sql('question')}) AS term FROM questions) qt
                ON qt.item_id = d.item_id AND qt.term = d.term
              GROUP BY d.item_id, d.chunk_id, d.dl, d.term) t) h
      JOIN (SELECT m.item_id, count(*) AS n_docs, avg(len({w})) AS avgdl FROM tmerged m
            JOIN uchunks u ON u.chunk_id = m.chunk_id GROUP BY m.item_id) st USING (item_id)
      GROUP BY item_id, chunk_id) s ON s.item_id = m.item_id AND s.chunk_id = m.chunk_id))
WHERE rank <= {KEEP_TOP_K}"""


@register("expand_queries", "V6", fx.with_views("SELECT item_id, variant_no, query_text FROM variants",
                                                 extra={"questions": _questions_sql(), "variants": VARIANTS_SQL}))
def expand_queries(spark, sf_dir):
    return question_variants(spark, sf_dir).select("item_id", "variant_no", "query_text")


@register("text_topk", "V1 V3 U2", fx.with_views(
    "SELECT item_id, variant_no, CAST(rank AS BIGINT) AS rank, chunk_id, score FROM thits",
    "articles", extra=text_ctes(), recursive=True))
def text_topk(spark, sf_dir):
    return text_hits(spark, sf_dir).select("item_id", "variant_no", "rank", "chunk_id", "score")


DATE_FILTER = "2024-01-05"


@register("search_with_date_filter", "P16 P17", fx.with_views(
    "SELECT item_id, variant_no, CAST(rank AS BIGINT) AS rank, chunk_id, score FROM thits",
    "articles", extra=text_ctes(DATE_FILTER), recursive=True))
def search_with_date_filter(spark, sf_dir):
    return text_hits(spark, sf_dir, F.col("published_at") == DATE_FILTER) \
        .select("item_id", "variant_no", "rank", "chunk_id", "score")


def reranked(spark, sf_dir):
    hits = text_hits(spark, sf_dir, corpus_cols=("chunk_content",))
    merged = S.merge_dedup_topk(hits, "item_id", "chunk_id", MERGED_TOP, carry=("chunk_content",))
    # The candidate set (<= 5 rows per question) feeds several branches of the rerank; write it once
    # to the shared folder instead of re-running the search per branch.
    merged = materialize(merged, "rerank-candidates")
    return S.bm25_rerank(merged, questions(spark, sf_dir), "item_id", "chunk_id", "chunk_content", "question",
                         KEEP_TOP_K), merged


@register("rerank_bm25", "V4 V5", fx.with_views(_bm25_sql(), "articles", extra=text_ctes(), recursive=True))
def rerank_bm25(spark, sf_dir):
    r, _ = reranked(spark, sf_dir)
    return r.select("item_id", "chunk_id", "bm25", "rank")


def _context_sql() -> str:
    return (f"SELECT r.item_id, string_agg(u.chunk_content, '/n' ORDER BY r.rank) AS context "
            f"FROM ({_bm25_sql()}) r JOIN uchunks u ON u.chunk_id = r.chunk_id GROUP BY r.item_id")


def contexts(spark, sf_dir):
    r, merged = reranked(spark, sf_dir)
    passages = r.join(merged.select("item_id", "chunk_id", "chunk_content"), ["item_id", "chunk_id"])
    return S.context_join(passages, "item_id", "chunk_content")


@register("context_join", "T25", fx.with_views(_context_sql(), "articles", extra=text_ctes(), recursive=True))
def context_join(spark, sf_dir):
    return contexts(spark, sf_dir)


@register("rag_prompts", "T21 V5 T25", fx.with_views(
    f"SELECT q.item_id, {P.fill_sql(P.RAG_PROMPT, question='q.question', context='c.context')} AS prompt "
    f"FROM questions q LEFT JOIN ({_context_sql()}) c ON c.item_id = q.item_id",
    "articles", extra=text_ctes(), recursive=True))
def rag_prompts(spark, sf_dir):
    c = contexts(spark, sf_dir)
    q = questions(spark, sf_dir)
    return q.join(c, "item_id", "left").select(   # a question without hits gets an empty context
        "item_id", P.fill(P.RAG_PROMPT, question=F.col("question"), context=F.col("context")).alias("prompt"))
