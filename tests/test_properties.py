"""Property tests: rewritten expressions equal their step-by-step definitions on random input."""

from hypothesis import given, settings
from hypothesis import strategies as st

from inkstream.functions import text as T

ALPHABET = st.sampled_from(
    list("ab Z09 .!?\t\n\r") + [" ", "　", "é", "“", "”", "‘", "’", "😀", "→", "↓",
                                chr(0x1D5D4), chr(0x1D7EC), chr(0x1D7CE), chr(0x1D622), "&apos;",
                                "https://x.y/z", "www.a.b", "\x0b", "\x1c"])
TEXTS = st.lists(ALPHABET, max_size=30).map("".join)


def stepwise(c):
    x = T.unbold(c)
    x = T.unitalic(x)
    x = T.strip_emoji(x)
    x = T.py_strip(x)
    x = T.unicode_quotes(x)
    x = T.ascii_only(x)
    return T.mask_urls(x)


@settings(max_examples=50, deadline=None)
@given(st.lists(TEXTS, min_size=20, max_size=40))
def test_clean_text_equals_stepwise_chain(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select("x", T.clean_text("x").alias("fast"), stepwise("x").alias("slow")).collect()
    bad = [r for r in rows if r.fast != r.slow]
    assert not bad, bad[:3]


@settings(max_examples=50, deadline=None)
@given(st.lists(TEXTS, min_size=20, max_size=40))
def test_py_strip_equals_python_strip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select("x", T.py_strip("x").alias("y")).collect()
    assert all(r.y == r.x.strip() for r in rows)
