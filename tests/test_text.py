"""Edge cases of the text and date column functions on hand-written rows."""

from pyspark.sql import functions as F

from inkstream.functions import dates as D
from inkstream.functions import text as T


def one(spark, value, expr, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


def test_unbold_maps_letters_and_only_the_mapped_digits(spark):
    bold_a, bold_z = chr(0x1D5D4), chr(0x1D607)
    bold_digit_0, unmapped_digit = chr(0x1D7EC), chr(0x1D7CE)
    assert one(spark, bold_a + bold_z + bold_digit_0 + unmapped_digit, T.unbold("x")) == "Az0" + unmapped_digit


def test_unitalic(spark):
    assert one(spark, chr(0x1D608) + chr(0x1D63B), T.unitalic("x")) == "Az"


def test_emoji_run_becomes_one_space(spark):
    assert one(spark, "a😀😀→↓b", T.strip_emoji("x")) == "a b"


def test_clean_text_order_and_fast_path_agree(spark):
    noisy = "  “Hi” 😀 &apos;ok&apos; see https://x.example/a?b=1 now "
    out = one(spark, noisy, T.clean_text("x"))
    assert out == "\"Hi\"   'ok' see [URL] now"
    ascii_in = "  plain &apos;text&apos; www.site.example/x end \n"
    assert one(spark, ascii_in, T.clean_text("x")) == "plain 'text' [URL] end"


def test_clean_text_is_ascii_and_has_no_url(spark):
    out = one(spark, "é https://a.b/c 𝗕 — www.x.y", T.clean_text("x"))
    assert out.isascii() and "http" not in out and "www." not in out


def test_url_mask_after_ascii_removal_swallows_glued_text(spark):
    # the reference masks URLs after dropping non-ASCII, so glued text joins the URL
    assert one(spark, "https://a.bé tail", T.clean_text("x")) == "[URL] tail"


def test_masks(spark):
    assert one(spark, "on 12/05/2024 and 2024-1-2", T.mask_dates("x")) == "on [DATE] and [DATE]"
    assert one(spark, "at 10:30 AM, 7:05:59", T.mask_times("x")) == "at [TIME], [TIME]"
    assert one(spark, "<p class='a'>x</p>", T.strip_tags("x")) == "x"
    assert one(spark, " a \t\n b  ", T.norm_ws("x")) == "a b"


def test_first_sentence_null_and_separators(spark):
    assert one(spark, None, T.first_sentence("x")) == ""
    assert one(spark, "Hello there! Next", T.first_sentence("x")) == "Hello there"
    assert one(spark, "line one\nline two", T.first_sentence("x")) == "line one"


def test_links_range_quirk(spark):
    assert one(spark, "see http://a.b", T.has_links("x")) is True
    assert one(spark, "no link here", T.has_links("x")) is False


def test_word_count_single_spaces(spark):
    assert one(spark, "", T.word_count("x")) == 1
    assert one(spark, "a  b", T.word_count("x")) == 3


def test_split_and_join_separators(spark):
    assert one(spark, " a #next-question#  #next-question# b", T.split_separator("x")) == ["a", "b"]
    arr = spark.createDataFrame([([" p1 ", "  ", "p2"],)], "x array<string>")
    assert arr.select(T.join_passages("x")).first()[0] == "p1\n#next-document#\np2"


def test_json_array_extract(spark):
    ok = one(spark, 'x [{"instruction":"i","content":"0"}] y', T.json_array_extract("x"))
    assert ok[0]["instruction"] == "i"
    assert one(spark, "sorry", T.json_array_extract("x")) is None
    assert one(spark, "] broken [", T.json_array_extract("x")) is None


def test_eval_scores(spark):
    assert one(spark, "Relevance - 4\nx", T.eval_score("x", "Relevance")) == 4
    assert one(spark, "nothing", T.eval_score("x", "Coherence")) is None


def test_dates(spark):
    assert one(spark, "May 6, 2024", D.parse_date("x")) == "2024-05-06"
    assert one(spark, "2024-05-06T01:02:03Z", D.parse_date("x")) == "2024-05-06"
    assert one(spark, "not a date", D.parse_date("x")) is None
    assert one(spark, "3 hours", D.relative_minutes("x")) == 180
    assert one(spark, "2 weeks", D.relative_minutes("x")) == 2 * 7 * 24 * 60
    assert one(spark, "5 months", D.relative_minutes("x")) is None
    assert one(spark, 90, D.minutes_before("2024-07-26 01:00:00", F.col("x")), "x bigint") == "2024-07-25"
