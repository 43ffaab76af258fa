import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from inkstream.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, noise=97):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    words, form, near = sorted(n), {}, {}
    for w in words:
        near[w] = [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def some_words(k, seed=1):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("aeioulnst") for _ in range(rnd.randint(5, 8))) for _ in range(k // 4)]
    out = set(base)
    while len(out) < k:
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(1, 2)):
            i = rnd.randrange(len(w))
            rnd.choice([lambda: w.insert(i, rnd.choice("aeéßÿ")), lambda: w.pop(i), lambda: w.__setitem__(i, rnd.choice("aeiÀ×"))])()
        if len(w) >= 5:
            out.add("".join(w))
    return {w: rnd.choice([3, 3, 4, 6, 12, 40, 200, 999]) for w in sorted(out)}


@pytest.mark.parametrize("cell,queries,leaf,sample", [(16384, 400_000, 48, 20_000), (40, 60, 4, 100), (7, 9, 2, 12)])
def test_equals_brute_force(spark, monkeypatch, cell, queries, leaf, sample):
    for name, value in (("CELL", cell), ("QUERIES", queries), ("LEAF", leaf), ("SAMPLE", sample)):
        monkeypatch.setattr(S, name, value)
    n = some_words(500)
    n |= {"".join(p): 5 for p in ("listen", "silent", "enlist", "tinsel", "inlets", "netsil", "lisent")}     # one letter multiset
    n |= {"a" * k: 3 * k for k in (5, 6, 7, 300)} | {"b" * 3000: 4, "b" * 3001: 8}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert result(S.variants(df)) == brute(n)


def test_words_of_documents(spark):
    rows = [(i, "Straße straße STRAßE, naïve naive Naïve L'été écoles écoles ÉCOLES x " + "hello " * (i % 5)) for i in range(200)]
    rows += [(7, None), (8, ""), (None, "null identity null identity " * 3), (9, "word" * 50), (3, "hello hello"), (3, "hello hello"),
             (10, "répété\nrépété\trépétés—répétés " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS id", "4 AS run")
    n = brute_counts(rows)
    got = S.counted_words(docs, noise=97)
    assert {r.word: r.n for r in got.collect()} == n
    assert result(S.variants(got)) == brute(n)
    assert {r.word: r.n for r in S.counted_words(docs).collect()} == brute_counts(rows, None)


def test_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    assert S.variants(S.counted_words(docs)).count() == 0
    assert S.variants(S.counted_words(docs.limit(0))).count() == 0


def test_search_prunes_and_finds_all_in_range():
    words = [w.encode("latin-1") for w in some_words(1500, 4) if len(w) == 6]
    counts = S.letter_counts(S.letter_codes(words, 6))
    tree = S.KdTree(counts, 8)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(words)))
    seen, pairs = 0, set()
    for leaf, q in tree.search(counts, 1, 1):
        seen += len(q)
        pairs |= {(a, b) for a in q.tolist() for b in tree.leaves[leaf].tolist()}
    assert seen < .7 * len(words) * len(tree.leaves)
    gap = counts[:, None, :] - counts[None, :, :]
    wanted = np.argwhere((np.maximum(gap, 0).sum(2) <= 1) & (np.maximum(-gap, 0).sum(2) <= 1))
    assert {tuple(p) for p in wanted.tolist()} <= pairs


def test_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = [tuple(None if x != x else x for x in r) for r in con.execute(S.SQL).fetchall()]
    assert sorted(got) == result(S.op12(spark, sf_dir))
