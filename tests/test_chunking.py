"""Section fold and token windows: edge cases and coverage invariants."""

import pytest
from pyspark.sql import functions as F

from inkstream.operators import chunking as C


def sections(spark, text):
    return spark.createDataFrame([(text,)], "x string").select(C.section_split("x")).first()[0]


def windows(spark, n, size=256, overlap=50):
    text = " ".join(f"t{i}" for i in range(n))
    return spark.createDataFrame([(text,)], "x string").select(C.token_windows("x", size, overlap)).first()[0]


def test_small_pieces_merge_up_to_500(spark):
    a, b = "a" * 200, "b" * 200
    assert sections(spark, f"{a}\n\n{b}") == [f"{a}\n\n{b}"]


def test_overflow_starts_new_section_and_strips(spark):
    a, b = "a" * 300, "b" * 300
    assert sections(spark, f"{a}\n\n{b}") == [a, b]


def test_big_piece_flushed_alone_unstripped(spark):
    a, big = "a" * 10, "b" * 600
    assert sections(spark, f"{a}\n\n{big}") == [a, "\n\n" + big]


def test_empty_text_has_no_sections(spark):
    assert sections(spark, "") == []


@pytest.mark.parametrize("n,count", [(0, 0), (1, 1), (256, 1), (257, 2), (462, 2), (463, 3)])
def test_window_counts(spark, n, count):
    assert len(windows(spark, n)) == count


def test_windows_cover_all_tokens_with_overlap(spark):
    w = windows(spark, 1000)
    toks = [t for x in w for t in x.split(" ")]
    assert set(toks) == {f"t{i}" for i in range(1000)}
    assert w[1].split(" ")[:50] == w[0].split(" ")[-50:]
    assert w[-1].split(" ")[-1] == "t999"


def test_chunk_rows_ids_are_md5_of_text(spark):
    df = spark.createDataFrame([("e1", "t", "2024-01-01", "x " * 300)], "entry_id string, title string, published_at string, c string")
    rows = C.chunk_rows(df, "c").select("chunk_id", F.md5("chunk_content").alias("m"), "chunk_no").collect()
    assert [r.chunk_no for r in rows] == [0, 1]
    assert all(r.chunk_id == r.m for r in rows)
