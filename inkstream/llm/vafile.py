"""Exact top-k by inner product with a vector-approximation file.

Vectors are made integer (floor of ``SCALE`` times each component). Equal vectors are one class, kept
with the ``k + 1`` rows of the smallest ids (a rank window, reduced before the shuffle): more copies can't be
among the best of any query. Each dimension is cut into ``2 ** BITS`` even cells between its extremes
over all classes; the approximation file holds one byte per dimension.

For a block of query vectors (``BLOCK``, collected and broadcast one block at a time; the
query set is stated by the caller):

1. Scan the approximation file: the cells bound each score from below and above. Every task returns
   the ``k`` best lower bounds of each query; the k-th best of all is a floor below which no score is
   of interest.
2. Scan it again and keep the classes whose upper bound reaches the floor.
3. Read the exact vectors of those classes in order of their bounds (best first), until the k-th exact
   score is over the next bound, and rank them. The candidates of a query are dealt to stripes, which are read
   apart, so that no query is the work of one task.

Each block's result is written and its broadcasts are dropped before the next. Bounds are products of float64
matrices, exact for integers of moderate size and widened by a rounding margin otherwise; scores are exact
integers of any size (over 64 bits in a result: an error).

Cases: vectors that are null or hold null or non-finite components take no part; vectors of
different lengths never meet (each length is searched on its own; length 0 scores 0); null ids take no part; rows
that repeat an id, with the same vector or another, are rows of their own, and a query meets all rows but itself;
equal scores go to the smaller id; queries with fewer than k candidates get all; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkstream.llm.common import materialize, read
from inkstream.llm.intvec import SCALE, checked, integer_vectors, matrix, scores

BITS = 6
BLOCK = 2048             # query vectors searched together
CHUNK = 1024             # vectors scored at once
K = 5


class Cells:
    """Even cells between the extremes of each dimension."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int):
        self.low, self.count = low.astype(np.int64), 2 ** bits
        self.width = np.array([(int(b) - int(a)) // self.count + 1 for a, b in zip(low, high)], np.int64)

    def pack(self, v: np.ndarray) -> np.ndarray:
        return ((v - self.low) // self.width).astype(np.uint8)

    def bounds(self, cells: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest score of each row's cells with each query."""
        lo = (self.low + cells.astype(np.int64) * self.width).astype(np.float64)
        hi = lo + (self.width - 1)
        plus, minus = np.maximum(q, 0).astype(np.float64).T, np.minimum(q, 0).astype(np.float64).T
        least, most = lo @ plus + hi @ minus, hi @ plus + lo @ minus
        size = max(np.abs(lo).max(initial=0), np.abs(hi).max(initial=0)) * float(np.abs(q).max(initial=0))
        if size * len(self.low) >= 2.0 ** 52:
            slack = (np.maximum(np.abs(lo), np.abs(hi)) @ np.abs(q.astype(np.float64)).T) * 1e-12 + 1
            least, most = least - slack, most + slack
        return least, most


def _approximations(classes: DataFrame, cells: Cells, dim: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            packed = cells.pack(matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in packed], pa.binary())],
                                             ["class", "cells"])

    return materialize(classes.select("class", "v").mapInArrow(run, "class long, cells binary"), "va-file")


def _scan(batches, cells: Cells, queries: np.ndarray, dim: int):
    """(class ids, lower bounds, upper bounds) of a chunk with all queries."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(ids), dim)
        for at in range(0, len(ids), CHUNK):
            yield ids[at:at + CHUNK], *cells.bounds(data[at:at + CHUNK], queries)


def _search_block(va: DataFrame, classes: DataFrame, shared, n_queries: int, dim: int, k: int) -> DataFrame:
    """``q, class, score``, written: for each query vector at least the classes of its ``k`` best ids."""
    def floors(batches):
        cells, queries = shared.value
        best = np.full((n_queries, k), -np.inf)
        for _, low, _ in _scan(batches, cells, queries, dim):
            both = np.concatenate([best, low.T], 1)
            best = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k:]
        q, _ = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(best[best > -np.inf])], ["q", "low"])

    low = va.mapInArrow(floors, "q int, low double")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("low")))
    rows = low.withColumn("r", rank).where(F.col("r") == k).select("q", "low").collect()   # one per query
    floor = np.full(n_queries, -np.inf)
    for q, value in rows:
        floor[q] = value
    limit = va.sparkSession.sparkContext.broadcast(floor)

    def survivors(batches):
        cells, queries = shared.value
        for ids, _, most in _scan(batches, cells, queries, dim):
            i, q = np.nonzero(most >= limit.value)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(q.astype(np.int32)), pa.array(most[i, q])],
                                             ["class", "q", "most"])

    candidates = va.mapInArrow(survivors, "class long, q int, most double")
    stripes = int(va.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stripe = F.pmod(F.xxhash64("class"), F.lit(stripes)).cast("int").alias("stripe")
    near = candidates.join(classes.select("class", "v"), "class").select("q", stripe, "class", "most", "v")

    def exact(batches):
        """Rows come by query, best bound first; a query is done when its k-th score is over the
        next bound. Equal scores go on, so that ties are all seen."""
        _, queries = shared.value
        last, now, best, done = None, -1, [], False
        for batch in batches:
            q, stripe, c, most = (batch.column(x).to_numpy(zero_copy_only=False) for x in (0, 1, 2, 3))
            v = matrix(batch.column(4), dim)
            out = []
            starts = np.flatnonzero(np.append(True, (q[1:] != q[:-1]) | (stripe[1:] != stripe[:-1]))) if len(q) else []
            for s, e in zip(starts, [*starts[1:], len(q)]):
                if (q[s], stripe[s]) != last:
                    last, now, best, done = (q[s], stripe[s]), int(q[s]), [], False
                for at in range(s, e, 64):
                    if done or len(best) == k and best[0] > most[at]:
                        done = True
                        break
                    score = scores(v[at:min(at + 64, e)], queries[now:now + 1])[:, 0]
                    out += zip([now] * len(score), c[at:at + len(score)].tolist(), score.tolist())
                    best = sorted([*best, *score.tolist()])[-k:]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), *[
                pa.array([o[x] for o in out], pa.int64()) for x in (1, 2)]], ["q", "class", "score"])

    ordered = near.repartition("q", "stripe").sortWithinPartitions("q", "stripe", F.desc("most"), "class")
    found = materialize(ordered.mapInArrow(exact, "q int, class long, score long"), "va-found")
    limit.destroy()
    return found


def top_k(table: DataFrame, is_query: Column, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
          scale: int = SCALE, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row for which ``is_query`` holds (an expression
    over the id, named ``id``)."""
    spark = table.sparkSession
    rows = materialize(integer_vectors(table, id_col, vec_col, scale=scale), "va-vectors")
    same = W.partitionBy("v").orderBy("id", "row")
    members = materialize(rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
                          .select("row", "id", "v", F.first("row").over(same).alias("class")), "va-members")
    classes = members.where("row = class")         # a class is named by its first row
    asked = rows.where(is_query).join(classes.select("v", "class"), "v").select("row", "id", "class", F.size("v").alias("dim"))
    asked = materialize(asked, "va-asked")
    parts = []
    for (dim,) in sorted(tuple(r) for r in asked.select("dim").distinct().collect()):
        own = classes.where(F.size("v") == dim)
        ends = own.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("a"), F.max("x").alias("b")).collect()
        low, high = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for d, a, b in ends:
            low[d], high[d] = a, b
        cells = Cells(low, high, bits)
        va = _approximations(own, cells, dim)
        wanted = materialize(asked.where(F.col("dim") == dim).select("class").distinct().join(own, "class"), "va-wanted")
        n = max(1, -(-wanted.count() // block))
        for b in range(n):
            some = wanted.where(F.pmod(F.xxhash64("class"), F.lit(n)) == b).orderBy("class") if n > 1 else wanted.orderBy("class")
            got = some.toPandas()
            if not len(got):
                continue
            queries = np.array([np.asarray(v, np.int64) for v in got.v]).reshape(len(got), dim)
            shared = spark.sparkContext.broadcast((cells, queries))
            found = _search_block(va, own, shared, len(got), dim, k + 1)
            names = spark.createDataFrame([(i, int(c)) for i, c in enumerate(got["class"])], "q int, asked long")
            shared.destroy()
            parts.append(found.join(F.broadcast(names), "q").select("asked", "class", "score"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # the k + 1 best rows of each distinct query vector, then each query without itself
    ids = every.join(members.select("class", F.col("row").alias("hit"), F.col("id").alias("vec_id")), "class")
    best = W.partitionBy("asked").orderBy(F.desc("score"), "vec_id", "hit")
    ids = materialize(ids.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
                      .select("asked", "hit", "vec_id", "score"), "va-best")
    mine = asked.select("row", F.col("id").alias("query_id"), F.col("class").alias("asked")).join(ids, "asked")
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id", "hit")
    return (mine.where(F.col("hit") != F.col("row")).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", checked(F.col("score")).alias("score")))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 50 == 0)


SQL = """
WITH whole AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.r <> q.r AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""
