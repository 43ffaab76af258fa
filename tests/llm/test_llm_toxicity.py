import random

import numpy as np
from pyspark.sql import functions as F

from inkstream.llm import toxicity as X


def test_held_out_accuracy(spark):
    """About one in sixteen toxic labels of this table is on a text without any abusive word."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = X.train(docs, labels.where(~held))
    rows = X.score(docs, model).join(labels.where(held).withColumnRenamed("toxic", "label"), "doc_id").collect()
    hit = [r.toxic for r in rows if r.label == 1]
    false = [r.toxic for r in rows if r.label == 0]
    assert np.mean(hit) >= 0.85 and np.mean(false) <= 0.005
    assert np.mean([r.severity for r in rows if r.label == 1]) > 1 > np.mean([r.severity for r in rows if r.label == 0]) * 10


def test_graded_labels_share_weights(spark):
    rnd, rows, labels = random.Random(0), [], []
    for i in range(600):
        g = rnd.randrange(3)
        words = rnd.choices([f"w{k}" for k in range(50)], k=20) + ["foul"] * (g > 0) + ["vile"] * (g > 1)
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, g))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = X.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(model.cuts) == 2 and model.cuts[0] < model.cuts[1] and model.weights.ndim == 1
    got = {r.doc_id: r for r in X.score(docs, model).collect()}
    assert np.mean([got[i].grade == g for i, g in labels]) > .9
    p = np.array([model.over(t.encode()) for _, t in rows])
    assert (np.diff(p, axis=1) <= 0).all()


ODD = [(1, None), (2, ""), (None, "idiot " * 30), (3, "clean words"), (3, "clean words"), (4, "x" * 100000)]


def test_odd_rows(spark, sf_dir):
    model = X.trained(spark, sf_dir)
    docs = spark.createDataFrame([(*r, "a") for r in ODD], "doc_id long, text string, toxic string")
    got = X.score(docs, model).collect()
    assert len(got) == len(ODD)
    assert {r.toxic for r in got if r.doc_id in (1, 2, 3)} == {False}
    kept = X.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    bad = [r for r in got if r.toxic]
    assert kept.count() == len(ODD) - len(bad)
    assert X.drop_toxic(docs.limit(0), model).count() == 0 and X.score(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    for labels in ([], [(1, None), (None, 1)], [(3, 1)], [(3, 0)]):
        model = X.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {r.toxic for r in X.score(docs, model).collect()} == {False}


def test_long_texts_in_pieces(monkeypatch):
    text = b"One two, THREE four-five six " * 50
    want = X.features(text)
    monkeypatch.setattr(X, "PIECE", 16)
    assert X.features(text) == want and b"three" in want and b"3:fou" in want
