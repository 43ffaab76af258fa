"""Vector search, merge, rerank (V2..V8, A5, T25, P16, P17).

Plan shape (exact search): the corpus is scanned once; the query side is broadcast as a matrix in
blocks of bounded bytes, so every corpus row is scored against every query vector in place (the work of
exact search is |corpus| x |queries| by definition) with one numpy matrix product per bounded slice of rows. Each
task carries its top-k per query along and emits it once, so at most queries x k rows per task reach the
shuffle of the final ``row_number() <= k``, however many scores tie. Scores are rounded to 9 decimals
before ranking so mathematically equal cosines tie exactly, and ties break on the corpus id.

Approximate search (V7): random-hyperplane LSH with bits from the corpus size; the tables and the radius
of the probes follow from the recall measured against the exact search on a bounded sample of the
queries. An equi-join on (table, bucket) yields candidates that are then scored exactly.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from inkstream.operators.embedding import words
from inkstream.session import materialize

MAX_BROADCAST_BYTES = 64 << 20  # query vectors (as doubles) per broadcast block
SEARCH_ROWS = 2048              # corpus rows scored, and rows returned, at once
SCORE_DECIMALS = 9
BM25_K1 = 1.2
BM25_B = 0.75


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_score(a, a_norm, b, b_norm) -> Column:
    return F.round(dot(a, b) / (_c(a_norm) * _c(b_norm)), SCORE_DECIMALS)


def _query_blocks(queries: DataFrame, keys: list[str], dim: int, max_bytes: int) -> list[DataFrame]:
    """The queries in hash blocks of about ``max_bytes`` of vectors, each safe to broadcast."""
    blocks = max(1, -(-queries.count() * dim * 8 // max_bytes))
    if blocks == 1:
        return [queries]
    h = F.pmod(F.xxhash64(*keys), F.lit(blocks))
    return [queries.where(h == b) for b in range(blocks)]


def _best(table: pa.Table, corpus_id: str, k: int) -> pa.Table:
    """The k best rows of each query (column ``_q``), equal scores by the smaller id."""
    table = table.sort_by([("_q", "ascending"), ("score", "descending"), (corpus_id, "ascending")])
    q = table.column("_q").to_numpy()
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return table.filter(pa.array(place < k))


def _norms(m: np.ndarray) -> np.ndarray:
    return np.concatenate([np.sqrt((b * b).sum(axis=1)) for b in (m[i:i + SEARCH_ROWS] for i in range(0, max(len(m), 1), SEARCH_ROWS))])


def _task_topk_fn(bq, key_fields, corpus_id: str, corpus_vec: str, corpus_cols, k: int, out_schema):
    """Cosine of every (query, row) pair of a task by one matrix product per ``SEARCH_ROWS`` rows. The task
    carries its k best rows per query along (ids and scores are sorted, the other columns taken once for the rows that
    stay) and returns them at its end, in small batches: at most queries x k rows, however many scores are equal."""
    cols = list(corpus_cols)

    def fn(batches):
        qkeys, qmat = bq.value
        qn = _norms(qmat)
        held = None
        for rb in (b.slice(at, SEARCH_ROWS) for b in batches for at in range(0, b.num_rows, SEARCH_ROWS)):
            vec = rb.column(corpus_vec)
            lens = vec.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            parts = vec.flatten()
            if parts.null_count:                                        # vectors with NULL components
                holes = np.repeat(np.arange(len(lens)), np.maximum(lens, 0))[parts.is_null().to_numpy(zero_copy_only=False)]
                lens = np.where(np.isin(np.arange(len(lens)), holes), -1, lens)
            rows = np.flatnonzero(lens == qmat.shape[1])
            if not len(rows) or not len(qmat):
                continue
            ids = rb.column(corpus_id).take(pa.array(rows))
            rows = rows[pc.array_sort_indices(ids).to_numpy()]          # ties go to the smaller id
            cm = np.asarray(vec.take(pa.array(rows)).flatten(), dtype=np.float64).reshape(len(rows), qmat.shape[1])
            cn = np.sqrt((cm * cm).sum(axis=1))
            good = cn > 0
            rows, cm, cn = rows[good], cm[good], cn[good]
            if not len(rows):
                continue
            kk, found = min(k, len(rows)), []
            for q0 in range(0, len(qmat), 512):
                sc = np.round((qmat[q0:q0 + 512] @ cm.T) / np.outer(qn[q0:q0 + 512], cn), SCORE_DECIMALS)
                cut = -np.partition(-sc, kk - 1, axis=1)[:, kk - 1:kk]
                over, tied = sc > cut, sc == cut
                pick = over | tied & (np.cumsum(tied, axis=1) <= kk - over.sum(axis=1, keepdims=True))
                qi, ri = np.nonzero(pick)
                found.append((qi + q0, ri, sc[qi, ri]))
            qi, ri, score = (np.concatenate(x) for x in zip(*found))
            n, at = 0 if held is None else held.num_rows, rows[ri]
            new = pa.table([pa.array(qi), pa.array(score), rb.column(corpus_id).take(pa.array(at)), pa.array(at + n)],
                           names=["_q", "score", corpus_id, "_at"])
            more = pa.table([rb.column(c) for c in cols], names=cols)
            if held is not None:
                old = held.select(["_q", "score", corpus_id]).append_column("_at", pa.array(np.arange(n)))
                new, more = pa.concat_tables([old, new]), pa.concat_tables([held.select(cols), more])
            new = _best(new, corpus_id, k)
            held = new.drop_columns("_at")
            for c in cols:
                held = held.append_column(c, more.column(c).take(new.column("_at")))
            held = held.combine_chunks()
        for b in [] if held is None else held.to_batches(max_chunksize=SEARCH_ROWS):
            qi = b.column("_q").to_pylist()
            out = {f.name: pa.array([qkeys[i][j] for i in qi], type=out_schema.field(f.name).type)
                   for j, f in enumerate(key_fields)}
            out |= {c: b.column(c) for c in ("score", corpus_id, *cols)}
            yield pa.RecordBatch.from_arrays([out[f.name].cast(f.type) for f in out_schema], schema=out_schema)
    return fn


def unsearchable(queries: DataFrame, query_keys: list[str], query_vec: str, dim: int | None = None) -> DataFrame:
    """Queries that can't have hits, with the reason: no vector, NULL components, zero, wrong length."""
    v = F.col(query_vec)
    reason = F.when(v.isNull() | (F.size(v) == 0), "no vector").when(F.exists(v, lambda x: x.isNull()), "null component") \
        .when(~F.exists(v, lambda x: x != 0), "zero vector")
    if dim is not None:
        reason = reason.when(F.size(v) != dim, "wrong length")
    return queries.select(*query_keys, reason.alias("reason")).where("reason IS NOT NULL")


def topk_search(corpus: DataFrame, queries: DataFrame, k: int, *, corpus_id: str, corpus_vec: str,
                query_keys: list[str], query_vec: str, corpus_cols: tuple[str, ...] = (),
                predicate: Column | None = None, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Exact cosine top-k per query (V2/V3, with P16/P17 predicates applied to the corpus first).

    Queries are searched among the corpus vectors of their own length, each length on its own, in
    blocks of ``max_bytes`` that are broadcast as a matrix; with several blocks the corpus is written
    once and read per block. Every task returns at most k rows per query; the ``row_number() <= k``
    over those is small. Queries without a usable vector have no hits (``unsearchable`` names them).
    Returns query_keys..., rank, corpus_id, score, corpus_cols...
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = corpus.sparkSession
    if predicate is not None:
        corpus = corpus.where(predicate)
    c = corpus.select(corpus_id, corpus_vec, *corpus_cols)   # odd vectors are left out inside the task: a
    # filter on a vector that a UDF computes would be pushed below it and compute it twice
    key_fields = [queries.schema[q] for q in query_keys]
    out_struct = T.StructType([*key_fields, corpus.schema[corpus_id], T.StructField("score", T.DoubleType()),
                               *[corpus.schema[x] for x in corpus_cols]])
    out_arrow = to_arrow_schema(out_struct)
    w = Window.partitionBy(*query_keys).orderBy(F.col("score").desc(), F.col(corpus_id).asc())
    # the query side is computed once (it may embed texts) and then counted and read per block
    v = F.col(query_vec)
    qtable = materialize(queries.select(*query_keys, query_vec), "query-vectors").where(
        v.isNotNull() & ~F.exists(v, lambda x: x.isNull()) & F.exists(v, lambda x: x != 0))
    dims = sorted(r[0] for r in qtable.select(F.size(query_vec)).distinct().collect())
    blocks = [b for dim in dims for b in _query_blocks(qtable.where(F.size(query_vec) == dim), query_keys, dim, max_bytes)]
    if len(blocks) > 1:
        c = materialize(c, "corpus-vectors")
    parts = []
    for block in blocks:
        rows = block.toArrow()  # bounded by the size check above
        if not rows.num_rows:
            continue
        vectors = rows.column(query_vec).combine_chunks().flatten()
        qmat = np.asarray(vectors, dtype=np.float64).reshape(rows.num_rows, -1)
        qkeys = list(zip(*[rows.column(q).to_pylist() for q in query_keys]))
        bq = spark.sparkContext.broadcast((qkeys, qmat))
        scored = c.mapInArrow(_task_topk_fn(bq, key_fields, corpus_id, corpus_vec, corpus_cols, k, out_arrow), out_struct)
        best = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        if len(blocks) > 1:                          # the result is kept, the queries need not be
            best = materialize(best, "search-block")
            bq.destroy()
        parts.append(best)
    if not parts:
        parts = [spark.createDataFrame([], out_struct).withColumn("rank", F.lit(0))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*query_keys, F.col("rank").cast("bigint").alias("rank"), corpus_id, "score", *corpus_cols)


def merge_dedup_topk(hits: DataFrame, query_key: str, corpus_id: str, k: int = 5,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """V4: merge the hits of all variants, one row per (query, item) with its best score, top-k."""
    agg = [F.max("score").alias("score")] + [F.first(c, ignorenulls=True).alias(c) for c in carry]
    best = hits.groupBy(query_key, corpus_id).agg(*agg)
    w = Window.partitionBy(query_key).orderBy(F.col("score").desc(), F.col(corpus_id).asc())
    return best.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def flatten_hits(hits: DataFrame, query_key: str, variant_key: str, corpus_id: str) -> DataFrame:
    """A5: per query, the per-variant hit lists (each in rank order) flattened in variant order."""
    per_variant = hits.groupBy(query_key, variant_key).agg(
        F.array_sort(F.collect_list(F.struct("rank", corpus_id))).alias("h"))
    per_variant = per_variant.select(query_key, variant_key, F.transform("h", lambda x: x[corpus_id]).alias("ids"))
    per_query = per_variant.groupBy(query_key).agg(F.array_sort(F.collect_list(F.struct(variant_key, "ids"))).alias("v"))
    return per_query.select(query_key, F.flatten(F.transform("v", lambda x: x["ids"])).alias("hit_ids"))


def bm25_rerank(candidates: DataFrame, questions: DataFrame, query_key: str, corpus_id: str, text_col: str,
                question_col: str, keep_top_k: int = 3) -> DataFrame:
    """V5: BM25 of each candidate passage against its question, statistics over that question's
    candidates (the passages a reranker is shown). Returns query_key, rank, corpus_id, bm25."""
    passages = candidates.select(query_key, F.struct(F.col(corpus_id).alias("id"), words(text_col).alias("w")).alias("p"))
    per_query = passages.groupBy(query_key).agg(F.collect_list("p").alias("ps"))      # the few passages of a question
    asked = questions.select(query_key, F.array_distinct(words(question_col)).alias("terms"))
    g = per_query.join(asked, query_key, "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))
    n_docs = F.size("ps").cast("double")
    avgdl = F.aggregate("ps", F.lit(0.0), lambda acc, x: acc + F.size(x["w"])) / n_docs
    g = g.withColumn("avgdl", avgdl).withColumn("terms", F.transform("terms", lambda t: F.struct(
        t.alias("t"), F.size(F.filter("ps", lambda x: F.array_contains(x["w"], t))).alias("df"))))

    def part(term: Column, doc: Column) -> Column:
        tf = F.size(F.filter(doc["w"], lambda x: x == term["t"])).cast("double")
        idf = F.log(1 + (n_docs - term["df"] + 0.5) / (term["df"] + 0.5))
        return idf * tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * F.size(doc["w"]) / F.col("avgdl")))

    def total(doc: Column) -> Column:
        return F.aggregate(F.filter("terms", lambda t: t["df"] > 0), F.lit(0.0), lambda acc, t: acc + part(t, doc))

    scored = g.select(query_key, F.inline(F.transform("ps", lambda x: F.struct(
        x["id"].alias(corpus_id), F.round(F.coalesce(F.nanvl(total(x), F.lit(0.0)), F.lit(0.0)), SCORE_DECIMALS).alias("bm25")))))
    w = Window.partitionBy(query_key).orderBy(F.col("bm25").desc(), F.col(corpus_id).asc())
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= keep_top_k)


def context_join(ranked: DataFrame, query_key: str, text_col: str, sep: str = "/n") -> DataFrame:
    """Per query, the ranked passages joined with the separator in rank order (bounded group)."""
    g = ranked.groupBy(query_key).agg(F.array_sort(F.collect_list(F.struct("rank", text_col))).alias("p"))
    return g.select(query_key, F.array_join(F.transform("p", lambda x: x[text_col]), sep).alias("context"))


def vector_size_check(df: DataFrame, vec_col: str, dim: int) -> DataFrame:
    """V8: rows whose vector has the declared size are accepted; the rest are flagged, not dropped."""
    return df.withColumn("dim", F.size(vec_col).cast("bigint")).withColumn("accepted", F.col("dim") == dim)


# ----------------------------------------------------------------------------- V7 LSH
LSH_TABLES = 8           # tables at least
LSH_MOST_TABLES = 32
LSH_RECALL = 0.9         # share of the exact top-k that must be found
LSH_SAMPLE = 200         # queries on which it is measured
LSH_BUCKET = 32          # corpus rows per bucket that the number of bits aims at
LSH_PROBES = 1 << 12     # buckets of a query at most; beyond, the exact search is the cheaper one


def lsh_bits(n: int, bucket: int = LSH_BUCKET) -> int:
    """Bits per table for ``n`` corpus rows: buckets keep their size as the corpus grows."""
    return max(2, math.ceil(math.log2(max(n, 1) / bucket)))


def hyperplanes(dim: int, tables: int, bits: int, seed: int = 42) -> np.ndarray:
    """Random signs: component i of plane (table, bit) is +1 if md5("seed:table:bit:i") begins below 8."""
    sign = [[1.0 if hashlib.md5(f"{seed}:{t}:{b}:{i}".encode()).hexdigest()[0] < "8" else -1.0 for i in range(dim)]
            for t in range(tables) for b in range(bits)]
    return np.array(sign).reshape(tables * bits, dim)


def _flips(bits: int, radius: int) -> np.ndarray:
    """All bucket differences of at most ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)], dtype=np.int64)


def _buckets(df: DataFrame, id_cols: list[str], vec_col: str, planes: np.ndarray, tables: int, bits: int,
             probe: int) -> DataFrame:
    """One row per (id, table, bucket), for every bucket at most ``probe`` bits away."""
    dim = planes.shape[1]
    schema = T.StructType([*[df.schema[c] for c in id_cols], T.StructField("tbl", T.IntegerType()),
                           T.StructField("bucket", T.LongType())])
    arrow = to_arrow_schema(schema)
    flips = _flips(bits, int(probe))
    step = max(1, (1 << 20) // (tables * len(flips)))     # vectors per batch sent on

    def fn(batches):
        for whole in batches:
            for rb in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                m = np.asarray(rb.column(len(id_cols)).flatten(), dtype=np.float64).reshape(rb.num_rows, dim)
                code = ((m @ planes.T > 0).reshape(-1, tables, bits) * (1 << np.arange(bits))).sum(axis=2)
                every = (code[:, :, None] ^ flips).reshape(-1)
                row = pa.array(np.repeat(np.arange(rb.num_rows), tables * len(flips)))
                tbl = np.tile(np.repeat(np.arange(tables), len(flips)), rb.num_rows)
                yield pa.RecordBatch.from_arrays([*[rb.column(k).take(row) for k in range(len(id_cols))],
                                                  pa.array(tbl, pa.int32()), pa.array(every)], schema=arrow)

    return df.select(*id_cols, vec_col).mapInArrow(fn, schema)


def lsh_plan(corpus: DataFrame, queries: DataFrame, k: int, *, corpus_id: str, corpus_vec: str, query_keys: list[str],
             query_vec: str, dim: int, bits: int, seed: int = 42, recall: float = LSH_RECALL,
             sample: int = LSH_SAMPLE) -> tuple[int, int] | None:
    """Tables and probe radius with the fewest candidates that find ``recall`` of the exact top-k of at
    most ``sample`` queries (smallest hash of the keys). With more queries than that, two standard errors
    are added. Neighbours in the query's own direction are found anyway and don't count. None if no choice
    of at most ``LSH_PROBES`` buckets a query is enough."""
    some = materialize(queries.select(*query_keys, query_vec).orderBy(F.xxhash64(*query_keys), *query_keys)
                       .limit(sample + 1), "lsh-sample")
    rows = [tuple(r) for r in some.collect()]
    exact = topk_search(corpus.withColumn("_dv", F.col(corpus_vec)), some, k, corpus_id=corpus_id, corpus_vec=corpus_vec,
                        query_keys=query_keys, query_vec=query_vec, corpus_cols=("_dv",)).where("score < 1").collect()
    if not exact:
        return LSH_TABLES, 1
    vec = {r[:-1]: r[-1] for r in rows}
    planes = hyperplanes(dim, LSH_MOST_TABLES, bits, seed)
    side = [np.array(v, dtype=np.float64) @ planes.T > 0 for v in
            ([vec[tuple(r[c] for c in query_keys)] for r in exact], [r["_dv"] for r in exact])]
    apart = (side[0] != side[1]).reshape(len(exact), LSH_MOST_TABLES, bits).sum(axis=2)
    nearest = np.minimum.accumulate(apart, axis=1)         # over the first t tables
    choices = sorted((t * sum(math.comb(bits, b) for b in range(r + 1)), t, r)
                     for t in range(LSH_TABLES, LSH_MOST_TABLES + 1, 4) for r in range(1, bits + 1)
                     if t * sum(math.comb(bits, b) for b in range(r + 1)) <= LSH_PROBES)
    for _, t, r in choices:
        share = float((nearest[:, t - 1] <= r).mean())
        doubt = 2 * math.sqrt(recall * (1 - recall) / len(exact)) if len(rows) > sample else 0.0
        if share >= min(1.0, recall + doubt):
            return t, r
    return None


def lsh_topk(corpus: DataFrame, queries: DataFrame, k: int, *, corpus_id: str, corpus_vec: str,
             query_keys: list[str], query_vec: str, dim: int, tables: int | None = None, bits: int | None = None,
             radius: int | None = None, seed: int = 42) -> DataFrame:
    """V7: approximate top-k. Candidates are corpus rows that share a bucket of some table with the
    query or lie at most ``radius`` bits away (equi-join, no cap); every candidate is scored exactly. The
    number of bits follows from the corpus size; tables and radius, unless given, from the recall
    measured on the corpus (``lsh_plan``); where no plan reaches it the search is exact. Vectors that are NULL, hold NULL, or have another length than
    ``dim`` take no part."""
    def usable(df, vec):
        v = F.col(vec)
        return df.where(v.isNotNull() & (F.size(v) == dim) & ~F.exists(v, lambda x: x.isNull()))

    corpus, queries = usable(corpus, corpus_vec), usable(queries, query_vec)
    bits = bits or lsh_bits(corpus.count())
    if tables is None and radius is None:
        plan = lsh_plan(corpus, queries, k, corpus_id=corpus_id, corpus_vec=corpus_vec, query_keys=query_keys,
                        query_vec=query_vec, dim=dim, bits=bits, seed=seed)
        if plan is None:
            return topk_search(corpus, queries, k, corpus_id=corpus_id, corpus_vec=corpus_vec, query_keys=query_keys,
                               query_vec=query_vec)
        tables, radius = plan
    tables, radius = tables or LSH_TABLES, 1 if radius is None else radius
    planes = hyperplanes(dim, tables, bits, seed)
    cb = _buckets(corpus, [corpus_id], corpus_vec, planes, tables, bits, 0)
    qb = _buckets(queries, query_keys, query_vec, planes, tables, bits, radius)
    cand = qb.join(cb, ["tbl", "bucket"]).select(*query_keys, corpus_id).distinct()
    c = corpus.select(corpus_id, F.col(corpus_vec).alias("_dv"), norm(corpus_vec).alias("_dn"))
    q = queries.select(*query_keys, F.col(query_vec).alias("_qv"), norm(query_vec).alias("_qn"))
    scored = cand.join(c, corpus_id).join(q, query_keys).where((F.col("_dn") > 0) & (F.col("_qn") > 0)) \
        .select(*query_keys, corpus_id, cosine_score("_qv", "_qn", "_dv", "_dn").alias("score"))
    w = Window.partitionBy(*query_keys).orderBy(F.col("score").desc(), F.col(corpus_id).asc())
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k) \
        .select(*query_keys, "rank", corpus_id, "score")
