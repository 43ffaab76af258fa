import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkstream.llm import vafile as V


def brute(rows, is_query, k=5):
    whole = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(whole):
        if is_query(q):
            near = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(whole) if m != n and len(w) == len(v))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


def odd_rows():
    rnd = random.Random(0)
    f = lambda x: float(np.float32(x))
    rows = [(i, [f(rnd.gauss(0, .2)) for _ in range(8)]) for i in range(300)]
    rows += [(i, [f(.25)] * 8) for i in range(300, 450)]                       # one very common vector
    rows += [(i, [f(rnd.gauss(0, .2)) for _ in range(3)]) for i in range(450, 454)]
    rows += [(500, None), (501, [None] * 8), (502, [f(math.nan)] + [0.0] * 7), (503, [f(math.inf)] + [0.0] * 7), (510, []), (520, []),
             (None, [0.5] * 8), (10, rows[10][1]), (20, [f(.5)] * 8), (530, [f(.1)] * 12), (540, [-1e9] + [f(.3)] * 7),
             (541, [f(600000.)] + [0.] * 7), (542, [f(500000.)] + [0.] * 7), (30, [1.0] * 8), (31, [9.0] * 8), (31, [1.0] * 8)]
    return rows


@pytest.mark.parametrize("bits,block", [(6, 2048), (2, 7)])
def test_equals_brute_force(spark, bits, block):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, class int")
    got = V.top_k(df, F.col("id") % 10 == 0, bits=bits, block=block).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 10 == 0)


def test_large_components_are_exact(spark):
    df = spark.createDataFrame([(1, [1e9, 3.0]), (2, [1e5, 5.0]), (3, [1e5, 6.0]), (4, [-1e5, 0.0])], "vec_id long, embedding array<double>")
    got = V.top_k(df, F.col("id") == 1, k=2).collect()
    assert [(r.vec_id, r.score) for r in got] == [(3, 256 ** 2 * (10 ** 14 + 18)), (2, 256 ** 2 * (10 ** 14 + 15))]
    over = spark.createDataFrame([(1, [1e13]), (2, [1e13])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="over 64 bits"):
        V.top_k(over, F.col("id") == 1).collect()


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert V.top_k(df, F.col("id") % 2 == 0).count() == 0
    one = spark.createDataFrame([(2, [1.0])], "vec_id long, embedding array<float>")
    assert V.top_k(one, F.col("id") % 2 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(0)
    v, q = rng.integers(-300, 300, (500, 16)), rng.integers(-300, 300, (20, 16))
    for bits in (1, 3, 6, 8):
        cells = V.Cells(v.min(0), v.max(0), bits)
        low, high = cells.bounds(cells.pack(v), q)
        exact = v @ q.T
        assert (low <= exact).all() and (exact <= high).all()
