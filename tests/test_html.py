"""S8-S10 extraction contract on hand-written pages."""

from pyspark.sql import functions as F

from inkstream.sources import html as H

PAGE = ('<html><head><script>var t="</p>";</script></head><body><nav><p>menu</p></nav>'
        '<article class="x"><h1>Big &amp; <b>Bold</b> </h1><div class="s">Sum &lt;1&gt;</div>'
        '<time datetime="2024-05-06T01:02:03Z">May</time>'
        '<p>First <i>para</i>.</p><p>Advertisement here</p><p>unclosed one<p>last &quot;q&quot;</p>'
        '<h2>Sub</h2></article><footer><p>foot</p></footer></body></html>')


def extract(spark, html):
    """The first article of a page (None if it has none)."""
    bodies = spark.createDataFrame([(html,)], "h string").select(F.explode(H.article_bodies("h")).alias("body"))
    return bodies.select(*H.extract_article("body")).first()


def test_article_fields(spark):
    r = extract(spark, PAGE)
    assert r.title == "Big & Bold"
    assert r.summary == "Sum <1>"
    assert r.published_at == "2024-05-06"
    assert r.content == 'First para. unclosed one last "q"'


def test_missing_parts_are_null_or_empty(spark):
    r = extract(spark, "<article><p>only</p></article>")
    assert r.summary is None and r.published_at is None and r.title == "" and r.content == "only"
    assert extract(spark, "<html>no article</html>") is None


def test_every_article_of_a_page(spark):
    df = spark.createDataFrame([(PAGE + "<p>between</p>" + PAGE.replace("Big", "Next"),)], "h string")
    rows = df.select(F.posexplode(H.article_bodies("h")).alias("n", "body")).select("n", *H.extract_article("body")).collect()
    assert [(r.n, r.title) for r in rows] == [(0, "Big & Bold"), (1, "Next & Bold")]


def test_block_text_in_document_order(spark):
    out = spark.createDataFrame([(PAGE,)], "h string").select(H.block_text_join("h")).first()[0]
    assert out == 'Big & Bold First para. Advertisement here unclosed one last "q" Sub'


def test_url_topic_title(spark):
    df = spark.createDataFrame([("https://news.example/news/markets/btc-hits-high/",), ("http://a.example/en",)], "u string")
    rows = df.select(*H.url_topic_title("u")).collect()
    assert (rows[0].topic, rows[0].title) == ("markets", "btc hits high")
    assert rows[1].topic is None


def test_tags_match_in_any_case(spark):
    page = "<HTML><ARTICLE Class=x><H1>Big</H1><DIV>Sum</DIV><TIME DateTime=\"2024-05-06\">x</TIME><P>one</P><p>two<P>three</ARTICLE>"
    r = extract(spark, page)
    assert (r.title, r.summary, r.published_at, r.content) == ("Big", "Sum", "2024-05-06", "one two three")
    assert spark.createDataFrame([(page,)], "h string").select(H.block_text_join("h")).first()[0] == "Big one two three"


def test_character_references(spark):
    import duckdb

    texts = ["&#233;&eacute;&Eacute; &#x4e2d;&#x1F600;", "&amp;lt; &amp;amp;", "&nbsp;a&nbsp;", "&unknown; &#0; &#xD800; &#9999999; &;", "& &lt", "",
             "&lt;b&gt;&quot;&apos;&#39;&hellip;&euro;", "&szlig;&yuml;&times;&frac12;end"]
    want = ["éé\xc9 中\U0001f600", "&lt; &amp;", " a ", "&unknown; &#0; &#xD800; &#9999999; &;", "& &lt", "", "<b>\"''…€", "ßÿ×½end"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", H.decode_entities("t").alias("t")).collect()
    assert [r.t for r in sorted(rows, key=lambda r: r.i)] == want
    assert [duckdb.execute(f"SELECT {H.decode_entities_sql('t')} FROM (SELECT ? AS t)", [t]).fetchone()[0] for t in texts] == want
