import random
import tracemalloc

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from inkstream.llm import simhash as S
from inkstream.session import owned_folders


def plain_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """print -> set of prints of its component"""
    left, out = set(prints), {}
    while left:
        todo, group = [left.pop()], set()
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 4}
            left -= near
            todo += near
        out |= {x: group for x in group}
    return out


def check(rows, got):
    prints = [plain_print(t) for _, t in rows]
    groups = plain_components(prints)
    want = []
    for (i, _), p in zip(rows, prints):
        ids = [j for (j, _), q in zip(rows, prints) if q in groups[p] and j is not None]
        want.append((str(i), f"{p:016x}", str(min(ids, default=None))))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == sorted(want)


def texts(seed=0, n=120):
    rnd, out = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    for _ in range(n // 4):
        w = rnd.choices(vocabulary, k=rnd.choice([2, 5, 60, 200]))
        out.append(" ".join(w))
        for _ in range(3):
            v = list(w)
            for _ in range(rnd.choice([0, 0, 1, 3])):
                v[rnd.randrange(len(v))] = rnd.choice(vocabulary)
            out.append(rnd.choice([" ", "\n", " \t"]).join(v).upper() if rnd.random() < .3 else " ".join(v))
    return out


ODD = [(None, "w1 w2 w3 w4 w5"), (None, None), (900, ""), (901, " \x0b "), (902, None), (5, "w1 w2 w3 w4 w5"), (5, "w1 w2 w3 w4 w5"),
       (903, "É w\xa0x y z"), (None, "nobody has an id here"), (None, "nobody has an id here")]


def test_fingerprints_equal_spark_hash(spark):
    t = "thntblere of then, edtioner in inea"
    w = t.split()
    hashes = spark.createDataFrame([(" ".join(w[i:i + 4]),) for i in range(3)], "s string").select(F.xxhash64("s")).collect()
    assert [r[0] % 2**64 for r in hashes] == [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(3)]
    assert S.fingerprint(t.encode()) == plain_print(t)


def test_long_text_in_pieces(monkeypatch):
    t = " ".join(texts(5, 8)).encode()
    want = plain_print(t.decode())
    monkeypatch.setattr(S, "PIECE", 7)
    assert S.fingerprint(t) == want


@pytest.mark.parametrize("parts,block", [(None, 1024), (2, 1024), (3, 8), (4, 8)])
def test_equals_brute_force(spark, parts, block):
    rows = [(i, t) for i, t in enumerate(texts())] + ODD
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash"))
    check(rows, S.near_duplicates(docs, parts=parts, block=block).collect())


def test_dense_group_and_chain(spark):
    """Many prints around one and a chain of prints 4 bits apart: components, no pair missed."""
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 2**63))
    dense = [centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 7)), replace=False)) for _ in range(600)]
    chain = [int(rng.integers(0, 2**63))]
    for k in range(40):
        chain.append(chain[-1] ^ sum(1 << (4 * k + b) % 64 for b in range(4)))
    prints = sorted(set(dense + chain + [int(x) for x in rng.integers(0, 2**63, 500)]))
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    groups = plain_components(prints)
    for block in (1024, 64):
        links = S.find_links(df, S.make_plan(df, 4), block)
        edges = [(r.a % 2**64, r.b % 2**64) for r in links.collect()]
        assert all((a ^ b).bit_count() <= 64 and b in groups[a] for a, b in edges)
        assert len(edges) <= 8 * len(prints)
        root = {r.a % 2**64: r.b for r in S.components(links).collect()}
        for p in prints:
            assert root.get(p, int(np.uint64(p).astype(np.int64))) == min(int(np.uint64(q).astype(np.int64)) for q in groups[p])


def test_near_copies_are_linked_in_bounded_memory():
    """Blocks of near copies, nearly every pair linked: no list of the pairs is held."""
    rng = np.random.default_rng(3)
    centre, n, k = int(rng.integers(0, 2**62)), 1600, 5
    near = {centre}
    while len(near) < n:
        near.add(centre ^ 1 << int(rng.integers(62)) ^ 1 << int(rng.integers(62)))
    prints = np.tile(np.array(sorted(near), np.int64), k)
    role, group = np.full(n * k, 3), np.repeat(np.arange(k), n)
    tracemalloc.start()
    try:
        a, b = S.links(prints, role, group, 4)
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()
    assert sorted(a.tolist()) == sorted(near)[1:] and set(b.tolist()) == {min(near)}


@pytest.mark.parametrize("cells", [1, 300, 1 << 18])
def test_links_of_groups_equal_brute_force(monkeypatch, cells):
    """Groups of any size, rows of each role, comparisons in pieces of any size."""
    monkeypatch.setattr(S, "CELLS", cells)
    rng = np.random.default_rng(cells)
    for bits, n in ((6, 40), (12, 300), (20, 300), (26, 500)):
        prints, role = rng.integers(0, 1 << bits, n), rng.integers(1, 4, n)
        group = np.sort(rng.integers(0, 4, n))
        i, j = np.triu_indices(n, 1)
        ok = (group[i] == group[j]) & ((role[i] | role[j]) == 3) & (prints[i] != prints[j])
        ok &= np.bitwise_count(prints[i] ^ prints[j]) <= 4
        want = S.stars(prints[i[ok]], prints[j[ok]])
        got = S.links(prints, role, group, 4)
        assert sorted(zip(*got)) == sorted(zip(*want))


@pytest.mark.parametrize("m", [3, 5])
def test_probing_rows_come_in_bounded_batches(m):
    rng = np.random.default_rng(m)
    x = rng.integers(-2**62, 2**62, 100 if m == 3 else 1000)
    parts = [list(range(k, 64, m)) for k in range(m)]
    counts = {(i, k): np.bincount(S.values(x, h), minlength=1 << len(h))
              for i, p in enumerate(parts) for k, h in enumerate(S.halves(p))}
    plan = S.Plan(len(x), parts, counts, 4)
    plan.thresholds = lambda prints: np.tile(np.array([4] + [-1] * (m - 1), np.int8), (len(prints), 1))
    seen = 0
    for _, key, prints, role in plan.rows(x):
        assert len(key) == len(prints) == len(role) <= S.PROBES
        seen += int((role == 2).sum())
    assert seen == len(x) * (S.ball(len(parts[0]), 4) - 1)


def test_component_steps_write_few_files(spark):
    """However many shuffle partitions, a step of few links writes no more files than there are slots."""
    chain = spark.createDataFrame([(k + 1, k) for k in range(200)], "a long, b long")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("40", "false")):
            spark.conf.set(k, v)
        with owned_folders(spark) as made:
            got = sorted(map(tuple, S.components(chain).collect()))
            files = [len(spark.read.parquet(p).inputFiles()) for p in made]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == [(k, 0) for k in range(1, 201)]
    assert len(files) > 4 and max(files[1:]) <= spark.sparkContext.defaultParallelism


def test_thresholds_are_sound_and_avoid_crowded_values():
    rng = np.random.default_rng(0)
    x = rng.integers(-2**62, 2**62, 4000)
    x[:3000] = (x[:3000] & ~0xFFFF) | 7              # the low 16 bits are crowded
    parts = [list(range(k, k + 16)) for k in range(0, 64, 16)]
    counts = {(i, 0): np.bincount(S.values(x, p), minlength=65536) for i, p in enumerate(parts)}
    plan = S.Plan(len(x), parts, counts, 4)
    t = plan.thresholds(x)
    assert ((t + 1).sum(1) == 5).all()
    assert (t[:3000, 0] == -1).mean() > 0.9 and t[:3000, 1:].max() >= 1


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (5000, 64))
    x[:, 40] = x[:, 3]
    both = x.T @ x
    parts = S.deal_bits(5000, both.astype(float), 5)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert any(3 in p and 40 in p for p in parts)


def test_keep_one(spark):
    rows = [(i, t) for i, t in enumerate(texts(2, 40))] + ODD
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept_id string")
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    prints = {t: plain_print(t) for _, t in rows}
    groups = plain_components(prints.values())
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len({min(groups[p]) for p in prints.values()}) == len({min(groups[prints[t]]) for _, t in got})
    for i, t in got:
        ids = [j for j, u in rows if prints[u] in groups[prints[t]] and j is not None]
        assert i == min(ids, default=None)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).count() == 0 and S.keep_one(docs).count() == 0
