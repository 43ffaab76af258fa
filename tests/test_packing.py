"""Next-fit packing by runs, and the combine loop, against sequential folds."""

import random

import pytest

from inkstream.operators.indexing import index_within
from inkstream.operators.packing import combine, pack_next_fit


def fold(sizes, budget):
    """Pack numbers of documents in order."""
    out, pack, load = [], -1, None
    for x in sizes:
        if load is None or load + x > budget:
            pack, load = pack + 1, x
        else:
            load += x
        out.append(pack)
    return out


def some_rows():
    rnd = random.Random(7)
    rows = []
    for i in range(900):
        g = "hot" if i % 3 == 0 else None if i % 7 == 1 else "None" if i % 7 == 2 else f"g{i % 5}"
        rows.append((g, i, rnd.choice([0, 0, 150, 100, 101] + [rnd.randint(1, 40)] * 20)))
    rows += [("big", 5000 + i, (1 << 53) + i % 3) for i in range(20)] + [("zeros", 6000 + i, 0) for i in range(30)]
    return rows + [("absent", 7000 + i, None if i % 2 else 30) for i in range(20)]


@pytest.mark.parametrize("run,budget", [(1 << 16, 100), (7, 100), (1, 100), (3, 1000), (5, 1 << 55)])
def test_packing_equals_the_sequential_rule(spark, run, budget):
    rows = some_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "g string, o long, x long, pack_no string")
    got = {(r.g, r.o): r.pack_no for r in pack_next_fit(df, "g", "o", "x", budget=budget, run=run).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == g)
        want |= {(g, r[1]): k for r, k in zip(own, fold([r[2] or 0 for r in own], budget))}
    assert got == want


def test_empty(spark):
    assert pack_next_fit(spark.createDataFrame([], "g string, o long, x long"), "g", "o", "x").count() == 0


def test_null_and_the_word_none_are_two_groups(spark):
    df = spark.createDataFrame([(None if i % 2 else "None", i, 10) for i in range(40)], "g string, o long, x long")
    got = index_within(df, ["g"], ["o"], value_col="x", num_partitions=3).collect()
    for g in (None, "None"):
        own = sorted((r.o, r.idx, r.cum_before) for r in got if r.g == g)
        assert [(i, c) for _, i, c in own] == [(k, 10 * k) for k in range(20)]


def test_running_sums_are_whole_numbers(spark):
    df = spark.createDataFrame([("a", i, (1 << 53) + 1) for i in range(50)], "g string, o long, x long")
    got = index_within(df, ["g"], ["o"], value_col="x", num_partitions=4).collect()
    assert sorted((r.o, r.cum_before) for r in got) == [(i, i * ((1 << 53) + 1)) for i in range(50)]


def sequential(units, parts, keep, budget):
    """The combine loop of one group: (parts left, packs of each round)."""
    rounds = []
    while True:
        packs = fold([x for _, x in units], budget)
        if packs[-1] > 0 and (packs[-1] + 1) * 3 > len(units) * 2:
            packs = [k // 2 for k in range(len(units))]
        rounds.append(packs[-1] + 1)
        of = {u: k for (u, _), k in zip(units, packs)}
        kept = []
        for k in range(packs[-1] + 1):
            kept += [(k, *p[1:]) for p in sorted((p for p in parts if of[p[0]] == k), key=lambda p: (-p[3], p[1]))[:keep]]
        if packs[-1] == 0:
            return [p[1] for p in kept], rounds
        parts = kept
        units = [(k, sum(p[2] for p in kept if p[0] == k)) for k in sorted({p[0] for p in kept})]


@pytest.mark.parametrize("budget,keep", [(60, 2), (25, 3), (10 ** 6, 2)])
def test_combine_equals_the_sequential_fold(spark, budget, keep):
    rnd = random.Random(3)
    parts = [(i, 100 * i + j, rnd.randint(1, 9), float(rnd.randint(0, 20))) for i in range(80) for j in range(rnd.randint(1, 4))]
    units = [(i, sum(p[2] for p in parts if p[0] == i)) for i in range(80)]
    u = spark.createDataFrame([("d", *x) for x in units] + [(None, 1, 5), ("e", 3, 0)], "g string, unit long, n_tokens long")
    p = spark.createDataFrame([("d", *x) for x in parts] + [(None, 1, 7, 5, 1.0)], "g string, unit long, part long, n_tokens long, score double")
    left, rounds = combine(u, p, "g", keep, budget, run=11)
    want, counts = sequential(units, parts, keep, budget)
    got = left.collect()
    assert [r.part for r in sorted((r for r in got if r.g == "d"), key=lambda r: r["rank"])] == want
    assert [r.part for r in got if r.g is None] == [7] and not [r for r in got if r.g == "e"]
    if budget != 25:                                 # there the pairing looks at all groups together
        assert [r.where("g = 'd'").select("pack_no").distinct().count() for r in rounds] == counts
    assert len(rounds) <= 8
    best = sorted(parts, key=lambda x: (-x[3], x[1]))[:keep]
    assert want == [x[1] for x in best]
