import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from inkstream.llm import hard_negatives as H
from inkstream.llm.intvec import scores

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, positives=5, negatives=10, least=30, most=90):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for a, (i, v, label) in enumerate(kept):
        if not is_anchor(i):
            continue
        s = [(-sum(x * y for x, y in zip(v, w)), j, b != label) for n, (j, w, b) in enumerate(kept) if n != a and len(w) == len(v)]
        for ps, p, _ in sorted(x for x in s if not x[2])[:positives]:
            fit = sorted(x for x in s if x[2] and -least * ps <= -100 * x[0] <= -most * ps)
            out += [(i, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def rows_of(k, dim=8, seed=0):
    rnd = random.Random(seed)
    centre = [[rnd.gauss(0, .3) for _ in range(dim)] for _ in range(6)]
    return [(i, [x + rnd.gauss(0, .15) for x in rnd.choice(centre)], rnd.randrange(3)) for i in range(k)]


def odd_rows():
    rows = rows_of(400)
    rows += [(i, [.25] * 8, i % 2) for i in range(400, 700)]                      # one very common vector
    rows += [(i, [.3, .1, -.2], i % 3) for i in range(700, 712)]
    rows += [(800, None, 1), (810, [None] * 8, 1), (820, [math.nan] + [.1] * 7, 1), (830, [math.inf] + [.1] * 7, 1), (840, [], 1),
             (850, [], 2), (860, [.1] * 12, 1), (None, [.5] * 8, 1), (20, [.5] * 8, 0), (20, [.5] * 8, 0), (30, [.1] * 8, 1),
             (870, [.4] * 8, None), (880, [1e6] + [.3] * 7, 2), (890, [0.0] * 8, 0), (893, [-1e6] + [.3] * 7, 2)]
    return rows


@pytest.mark.parametrize("cell,queries,sample,leaf,degree,chunk", [
    (16384, 100_000, 20_000, 512, 8, 256), (90, 20, 200, 16, 4, 7), (40, 9, 30, 5, 3, 256)])
def test_equals_brute_force(spark, monkeypatch, cell, queries, sample, leaf, degree, chunk):
    for name, value in (("CELL", cell), ("QUERIES", queries), ("SAMPLE", sample), ("LEAF", leaf), ("CHUNK", chunk)):
        monkeypatch.setattr(H, name, value)
    monkeypatch.setattr(H.Gnat.__init__, "__defaults__", (degree,))
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", id int, row int").repartition(5)
    got = H.mine(df, F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 10 == 0)


def test_other_numbers_and_empty(spark):
    rows = rows_of(120, 4, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.mine(df, F.col("id") % 7 == 0, positives=2, negatives=3, least=-50, most=101).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 7 == 0, 2, 3, -50, 101)
    assert H.mine(df.limit(0), F.col("id") % 7 == 0).count() == 0
    one = [r for r in rows if r[2] == 1]
    assert H.mine(spark.createDataFrame(one, SCHEMA), F.col("id") % 7 == 0).count() == 0


def test_tree_eliminates_and_keeps_all_in_range():
    rng = np.random.default_rng(1)
    v = (rng.normal(0, 1, (2000, 3)) * 200).astype(np.int64)
    space = H.Space(float((v * v).sum(1).max()))
    tree = H.Gnat(space.rows(v), 32, 6)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(2000))
    a = v[:60]
    points, reach, margin = space.anchors(a)
    exact = a @ v.T
    high = np.sort(exact, 1)[:, -20:-19]
    low = np.sort(exact, 1)[:, -60:-59]
    seen, work = [set() for _ in a], 0
    for leaf, q in tree.search(points, margin, lambda q: H.radii(reach[q], low[q], high[q])):
        work += len(q) * len(tree.leaves[leaf])
        for i in q.tolist():
            seen[i] |= set(tree.leaves[leaf].tolist())
    for i in range(len(a)):
        assert set(np.flatnonzero((exact[i] >= low[i]) & (exact[i] <= high[i])).tolist()) <= seen[i]
    assert work < .7 * len(a) * len(v)


def test_scores_are_exact_at_any_size():
    a, b = np.array([[1 << 30, 3]]), np.array([[1 << 30, 5], [7, 1]])
    assert scores(a, b).tolist() == [[(1 << 60) + 15, 7 * (1 << 30) + 3]]
    a, b = np.array([[1 << 61, 1 << 61]]), np.array([[3, -3], [1, 0]])
    assert scores(a, b).tolist() == [[0, 1 << 61]]
    assert scores(a, np.concatenate([a, -a])).tolist() == [[(1 << 63) - 1, -(1 << 63) + 1]]      # an error in a result
    assert scores(np.zeros((2, 0), np.int64), np.zeros((3, 0), np.int64)).tolist() == [[0] * 3] * 2


@pytest.mark.parametrize("place", ["/root/testdata/sf0.001"])
def test_equals_sql(spark, place):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{place}/embeddings.parquet'")
    want = sorted(con.execute(H.SQL).fetchall())
    assert want and want == sorted(map(tuple, H.op13(spark, place).collect()))
