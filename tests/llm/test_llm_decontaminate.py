import time
import tracemalloc
import hashlib
import re

import numpy as np
import pytest

from inkstream.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=13):
    w, hit, names = words(text), set(), set()
    for i, t in items:
        own = words(t)
        n = min(window, len(own))
        for j in range(len(own) - n + 1) if n else ():
            for k in range(len(w) - n + 1):
                if w[k:k + n] == own[j:j + n]:
                    hit.update(range(k, k + n))
                    names.add(i)
    return len(w), len(hit), sorted(n for n in names if n is not None)


LONG = " ".join(f"w{i}" for i in range(40))
ITEMS = [(1, LONG), (2, "Short ITEM here"), (2, "other text of item two"), (3, ""), (4, None), (None, "nameless item words"),
         (5, "é" * 3 + " ünïcode 中文 x1"), (6, " ".join(["la"] * 20)), (7, "w20 w21 w22 w23 w24 w25 w26 w27 w28 w29 w30 w31 w32 zz")]
TEXTS = [None, "", "  .,;", "short, item; HERE", "a b c " + LONG, LONG + " filler " + " ".join(LONG.split()[5:25]), "la " * 50,
         "nameless-item words", "ééé ÜNÏCODE ünïcode 中文 x1 ééé ünïcode 中文 x1", " ".join(["pad"] * 400) + " short item here",
         " ".join(LONG.split()[:12]), LONG, LONG, "other text of item two other text of item two"]


@pytest.mark.parametrize("block_chars", [1 << 20, 60])
def test_equals_brute_force(spark, block_chars):
    docs = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = D.contamination(docs, bench, block_chars=block_chars).collect()
    assert sorted(r.doc_id or 0 for r in got) == list(range(len(TEXTS)))
    for r in got:
        n, hit, names = brute(TEXTS[r.doc_id or 0], ITEMS)
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, hit, names), TEXTS[r.doc_id or 0]
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
        w = words(TEXTS[r.doc_id or 0])
        for m in r.matches:                          # every match is verbatim
            assert any(words(t)[m.item_start:m.item_start + m.n_words] == w[m.doc_start:m.doc_start + m.n_words]
                       for i, t in ITEMS if i == m.item_id)
    kept = D.decontaminate(docs, bench, block_chars=block_chars)
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in got if r.contaminated}
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted((r.doc_id or 0) for r in got if r.doc_id not in bad)


def test_repeated_rows_and_empty_tables(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(1, LONG), (1, LONG), (None, LONG), (None, "clean"), (2, "clean")], "doc_id long, text string")
    for block in (1 << 20, 60):
        assert D.contamination(docs, bench, block_chars=block).count() == 5
        assert sorted(str(r.doc_id) for r in D.decontaminate(docs, bench, block_chars=block).collect()) == ["2", "None"]
    assert D.contamination(docs.limit(0), bench).count() == 0
    assert D.decontaminate(docs, bench.limit(0)).count() == 5
    assert {r.n_hit for r in D.contamination(docs, bench.limit(0)).collect()} == {0}


def test_longest_match_spans_windows(spark):
    bench = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x y " + " ".join(LONG.split()[3:33]) + " z")], "doc_id long, text string")
    row = D.contamination(docs, bench).first()
    assert row.longest_match == 30 and [tuple(m) for m in row.matches] == [(1, 3, 2, 30)]


def test_suffix_array_and_search_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 4, n).astype(np.int32) for n in (0, 5, 300, 40, 2)]
    names = {1: b"a", 2: b"b", 3: b"c"}
    items = D.Items([(9, "a b a b c a b"), (8, "c c"), (7, " ".join("abc"[i] for i in rng.integers(0, 3, 20)))], 5)
    number = {k: items.number[v] for k, v in names.items()}
    texts = [np.array([number.get(x, 0) for x in t], np.int32) for t in texts]
    plain = D.scan_shard(texts, items)
    monkeypatch.setattr(D, "SHARD_WORDS", 17)       # one shard, many suffix arrays
    assert D.scan_shard(texts, items) == plain
    d = np.append(texts[2], np.zeros(21, np.int32))
    order = D.suffix_array(d, np.arange(300), 20)
    rows = [tuple(d[s:s + 20]) for s in order]
    assert rows == sorted(rows) and sorted(order.tolist()) == list(range(300))
    lo, hi = D.search(d, order, items)
    text, test = d[:300].tolist(), items.words.tolist()
    for k, s in enumerate(items.starts.tolist()):
        n, g = int(items.length[k]), items.group[k]
        assert (g >= 0) == (n > 0)
        if n:
            own = test[s:s + n]
            first = int(items.starts[items.first[g]])
            assert test[first:first + n] == own
            assert hi[g] - lo[g] == sum(text[i:i + n] == own for i in range(301 - n))


def test_matches_are_all_maximal_runs():
    """Every run of equal words on a diagonal that holds a window, from its first to its last word."""
    rng = np.random.default_rng(3)
    letters = lambda n: [int(x) for x in rng.integers(1, 3, n)]
    own = [letters(30), [1] * 12, letters(4), [2, 2], []]
    items = D.Items([(k, " ".join("xab"[c] for c in t)) for k, t in enumerate(own)], 5)
    texts = [letters(200), [1] * 30, [0, 2, 2, 0, 2, 2, 2], [], letters(3)]
    code = {0: 0, 1: items.number[b"a"], 2: items.number[b"b"]}
    got = D.scan_shard([np.array([code[c] for c in t], np.int32) for t in texts], items, "matches")
    for t, g in zip(texts, got):
        want = []
        for k, o in enumerate(own):
            for shift in range(-len(o), len(t)):
                run = 0
                for j in range(len(o) + 1):
                    if j < len(o) and 0 <= j + shift < len(t) and t[j + shift] == o[j]:
                        run += 1
                        continue
                    if run and run >= min(5, len(o)):
                        want.append((k, j - run, j - run + shift, run))
                    run = 0
        assert sorted(g["matches"]) == sorted(want)
        assert g["longest"] == max((m[3] for m in want), default=0) and g["items"] == sorted({m[0] for m in want})


def test_query_digest(spark, sf_dir):
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    windows = {}
    for i, t in bench:
        w = words(t)
        n = min(13, len(w))
        for j in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[j:j + n]), set()).add(i)
    lengths = {len(k) for k in windows}
    got = {r.doc_id: r for r in D.op10(spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        w, hit, names = words(d.text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    names |= found
        r = got[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(names))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()


def test_repeated_words_cost_diagonals_not_pairs():
    """Equal words: one match a diagonal; a shard of them stays small and quick."""
    items = D.Items([(1, "a " * 40), (2, "a " * 5 + "b")], 13)
    (got,) = D.scan_shard([np.ones(300, np.int32)], items, "matches")
    assert (got["n_hit"], got["longest"], got["items"]) == (300, 40, [1])
    assert sorted(m[1:] for m in got["matches"]) == sorted(
        [(0, s, min(40, 300 - s)) for s in range(288)] + [(i, 0, 40 - i) for i in range(1, 28)])
    items = D.Items([(7, "a " * 400)], 13)
    tracemalloc.start()
    before = time.process_time()
    (got,) = D.scan_shard([np.ones(1 << 18, np.int32)], items, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got["n_hit"], got["longest"]) == (1 << 18, 400)
    assert peak < 300e6 and time.process_time() - before < 30


def test_many_empty_rows_are_passed_on(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_ROWS", 10)
    docs = spark.createDataFrame([(i, None if i % 2 else "") for i in range(95)], "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert sorted(r.doc_id for r in D.decontaminate(docs, bench).collect()) == list(range(95))
    assert D.contamination(docs, bench).where("n_words = 0 AND n_hit = 0").count() == 95
