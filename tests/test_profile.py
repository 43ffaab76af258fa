"""Key sentences: weightless words end where they are read, small tables are indexed by few tasks."""

import math
import re

import pytest

from inkstream.operators import indexing, profile

DOCS = [("d1", 1, "the cat sat. the dog"), ("d1", 2, "a cat! . The the of"), ("d2", 3, "the dog of? of cow"), (None, 4, "the 5 of"),
        ("d2", 5, None), ("d2", 6, "the the"), ("d1", 1, "the cat sat. the dog"), ("d3", 7, "of The ant")]


def seen(monkeypatch, module):
    tables, real = {}, module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: tables.setdefault(name, real(df, name)))
    return tables


def fold():
    split, tf, scores = (lambda t: [w for w in re.split(r"\W+", t.lower()) if w]), {}, {}
    for day, _, text in DOCS:
        for w in split(text or ""):
            tf[day, w] = tf.get((day, w), 0) + 1
    df = {w: len({d for d, x in tf if x == w}) for _, w in tf}
    for day, i, text in DOCS:
        for n, s in enumerate(re.split("[.!?]", text or "")):
            if ws := split(s):
                total = sum(max(0.0, tf[day, w] * math.log(3 / df[w])) for w in ws)
                scores.setdefault((day, i, n, len(ws)), []).append(total)
    return {k: round(sum(v) / k[3], 6) for k, v in scores.items()}


@pytest.mark.parametrize("common", [0, 1, 50_000])
def test_scores_do_not_depend_on_the_words_left_out_early(spark, monkeypatch, common):
    monkeypatch.setattr(profile, "COMMON_TERMS", common)
    tables = seen(monkeypatch, profile)
    df = spark.createDataFrame(DOCS, "day string, id long, text string")
    got = profile.sentence_scores(df, "day", "id", "text").collect()
    assert len(got) == len(fold()) and {(r.day, r.id, r.sent_no, r.n_words): round(r.score, 6) for r in got} == fold()
    left = {r.term for r in tables["sentence-words"].collect()}
    assert ("the" in left) == (common == 0) and ("of" in left) == (common < 2) and {"cat", "5", "ant", None} <= left


def test_a_small_table_is_indexed_by_few_tasks(spark, monkeypatch):
    tables = seen(monkeypatch, indexing)
    df = spark.createDataFrame([("g" if i % 3 else None, i, i % 5) for i in range(300)], "g string, o long, x long")
    got = {(r.g, r.o): (r.idx, r.cum_before) for r in indexing.index_within(df, ["g"], ["o"], value_col="x").collect()}
    own = [i for i in range(300) if i % 3]
    assert all(got["g", i] == (n, sum(j % 5 for j in own[:n])) for n, i in enumerate(own))
    assert tables["index-runs"].select("_pid").distinct().count() == 1
