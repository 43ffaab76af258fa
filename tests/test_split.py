"""The exact split."""

import pytest
from pyspark.sql import functions as F

from inkstream.operators import dataset as G


@pytest.mark.parametrize("bins", [2, 4096])
def test_smallest_equals_a_sort(spark, bins):
    rows = [((i * 7919) % 1000 * (1 << 40) + i % 3, f"k{i}") for i in range(300)] + [(77, f"same{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "h long, k string")
    for k in (0, 1, 5, 20, 21, 157, 319, 320, 400):
        got = [tuple(r) for r in df.where(G.smallest(df, k, "h", "k", bins)).collect()]
        assert sorted(got) == sorted(rows)[:k]


def test_share_is_exact_and_stable(spark):
    df = spark.createDataFrame([(i % 501 if i % 501 else None, f"t{i}") for i in range(1500)], "doc_id long, h string")
    got = G.train_val_split(df, "doc_id")
    assert got.columns == ["doc_id", "h", "split"]
    per_key = got.select("doc_id", "split").distinct()
    assert per_key.count() == 501 and per_key.where("split = 'train'").count() == round(.8 * 501)
    again = G.train_val_split(df.repartition(7, F.rand(1)), "doc_id").select("doc_id", "split").distinct()
    assert sorted(map(str, per_key.collect())) == sorted(map(str, again.collect()))
    assert G.train_val_split(df.limit(0), "doc_id").count() == 0
