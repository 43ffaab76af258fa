import html
import re
import time

import pytest

from inkstream.llm import html_density as H

BODY = "A paragraph of the article that is long enough to weigh more than what stands around it. "


def page(inner, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{x:1}}</style><script>var a='</p><p>no';</script></head><body>{before}"
            f"<article><h1>Head &amp; line</h1>{inner}</article>{after}</body></html>")


def test_boilerplate_goes():
    before = ("<header><h2>Site</h2></header><nav><ul><li><a href=x>menu one</a><li><a href=y>menu two</a></ul></nav>"
              "<div class='cookie-notice'>We use cookies for everything and you should read this very long notice about it.</div>")
    after = ("<aside>Side " + BODY * 5 + "</aside><div id=comments><p>Reader says " + BODY * 8 + "</p></div><form><p>Sign up</p></form>"
             "<div class='ad'>Buy " + BODY * 4 + "</div><footer>&copy; me</footer>")
    got = H.main_text(page(f"<p>{BODY}</p><p>Short.</p><p>{BODY} <b>bold</b>&nbsp;<a href=z>link</a></p>", before, after))
    assert got == f"Head & line\n\n{BODY.strip()}\n\nShort.\n\n{BODY.strip()} bold link"


def test_without_article_tag():
    text = ("<body><div class=nav><a href=1>one</a> <a href=2>two</a></div><div id=main><div class=post><h2>Title</h2>"
            f"<p>{BODY}<p>Tiny<ul><li>first<li>second</ul></div></div><div class=footer>foot</div></body>")
    assert H.main_text(text) == f"Title\n\n{BODY.strip()}\n\nTiny\n\nfirst\n\nsecond"


def test_names_of_states_are_no_junk():
    got = H.main_text(f"<body class='has-sidebar'><div class='wrap with-ads no-comments'><article class='post comments-open'><p>{BODY}</p>"
                      "<div class='comments'>said</div><div class='side-bar ad_box'>buy</div></article></div></body>")
    assert got == BODY.strip()


@pytest.mark.parametrize("attribute", ["class='content-sidebar-wrap'", "id='page-with-sidebar'", "class='sidebar'", "id=social-main"])
def test_wrappers_keep_the_article(attribute):
    ad = f"<div class='ad-box'>buy {BODY}</div><div class='sidebar-left'>side {BODY}</div><div class='site-footer'>foot</div>"
    inner = f"<p>{BODY}</p><p>Short.</p>"
    for core in (f"<article>{inner}</article>", f"<main>{inner}</main>", f"<div class=post>{inner}</div>"):
        assert H.main_text(f"<body><div {attribute}>{core}{ad}</div></body>") == f"{BODY.strip()}\n\nShort."


def test_parts_of_names_and_foreign_tags_are_no_junk():
    inner = (f"<p>{BODY}<span class='share-price'>12</span> <span class=ad>now</span></p><section class='social-policy'><p>Policy.</p></section>"
             "<p class='notice-period'>Period.</p><p>x <math><mi>y</mi></math> <object>fallback</object> <canvas>drawn</canvas></p>")
    assert H.main_text(page(inner)) == f"Head & line\n\n{BODY}12 now\n\nPolicy.\n\nPeriod.\n\nx y fallback drawn"


@pytest.mark.parametrize("source,want", [
    (None, ""), ("", ""), ("   ", ""), ("just text  here", "just text here"), ("<p>a<br>b\n c</p>", "a b c"), ("a < b &lt; c", "a < b < c"),
    ("<div><p>x<div>y</div>z</div>", "x\n\ny\n\nz"), ("<p>open <b>never closed", "open never closed"), ("<p>a</p></div></p><p>b</p>", "a\n\nb"),
    ("<p>a<!-- <p>no --> b<!-- open <p>c", "a b"), ("<script>x<p>y", ""), ("<nav>only menu</nav>", ""), ("<p title='a>b'>q</p><", "q\n\n<"),
    ("<article>t<span hidden>no</span> u</article>", "tno u"), ("<p>&#233;&eacute;&amp;amp;</p>", "éé&amp;"),
    ("<p>a &<b>lt;</b> b</p>", "a &lt; b"), ("<p>a<!-->b<!--->c<!-- x --!>d</p>", "abcd"),
])
def test_odd_pages(source, want):
    assert H.main_text(source) == want


def test_deep_and_long_pages():
    deep = "<div>" * 20000 + "<p>core text</p>" + "</div>" * 20000
    assert H.main_text(deep) == "core text"
    assert len(H.main_text(page(f"<p>{BODY}</p>" * 5000)).split("\n\n")) == 5001


MENU = "<div><a href=1>Home</a> <a href=2>World</a> <a href=3>Sport and more</a></div>"


def test_densities():
    p = H.Page(f"<body><div><a href=x>link</a></div><div><p>{BODY}</p></div></body>")
    each, total, body = p.densities()
    assert each[p.tag.index("p")] > each[p.tag.index("a")] and p.tag[body] == "body"
    assert H.main_text(f"<body><div><a href=x>link</a></div><div><p>{BODY}</p></div></body>") == BODY.strip()
    p = H.Page(f"<body><div><a href=x>link</a></div><div><p>{BODY}</p><p>{BODY}</p></div></body>")
    assert p.chosen()[0] == 4 and p.tag[4] == "div"


UNNAMED = [f"<body>{MENU}<article><p>{BODY}</p><p>Short.</p></article><div>Buy now</div></body>",
           f"<body><div>{MENU}<div><p>{BODY}</p><p>Short.</p></div><div><a href=4>Terms</a> <a href=5>Imprint</a></div></div></body>",
           f"<body>{MENU}<p>{BODY}</p><p>Short.</p></body>",
           f"<body><div><div>{MENU}</div><div><div><div><p>{BODY}</p><p>Short.</p></div></div></div></div></body>"]


@pytest.mark.parametrize("source", UNNAMED)
def test_density_decides_without_names(source):
    assert H.main_text(source) == f"{BODY.strip()}\n\nShort."


def test_without_density_the_choice_fails(monkeypatch):
    real = H.Page.densities
    monkeypatch.setattr(H.Page, "densities", lambda self, skipped=None: (
        [1.0] * len(self.tag), [1.0] * len(self.tag), real(self, skipped)[2]))
    assert all(H.main_text(u) != f"{BODY.strip()}\n\nShort." for u in UNNAMED[1::2])


def test_parts_of_the_article_beside_its_core():
    parts = [f"<section><h2>Part {i}</h2>" + f"<p>{BODY}</p>" * (i + 1) + "</section>" for i in range(3)]
    text = f"<body>{MENU}<h1>Title</h1><div>{''.join(parts)}</div><div>Buy</div></body>"
    assert H.main_text(text) == "\n\n".join(["Title"] + [x for i in range(3) for x in [f"Part {i}"] + [BODY.strip()] * (i + 1)])


@pytest.mark.parametrize("name", """reader-comments user-comments commentlist comment-thread post-comments article-comments related-articles
ad-300x250 google-ads adsbygoogle cookie-law-info privacy-notice page-sidebar social-media""".split())
def test_named_blocks_are_no_article_text(name):
    block = f"<div class='{name}'><p>{BODY}</p></div>"
    assert H.main_text(f"<body><article><p>{BODY}</p>{block}</article>{block}</body>") == BODY.strip()
    assert H.main_text(f"<body><div class=content><p>{BODY}</p><p>{BODY}</p>{block}</div>{block}</body>") == f"{BODY.strip()}\n\n{BODY.strip()}"


@pytest.mark.parametrize("part", ["<h2 id=comments>Word</h2>", "<h2 id=search>Word</h2>", "<h2 id=advertising>Word</h2>",
                                  "<section id=sponsor>Word</section>", "<p class=alert>Word</p>", "<p class=skip>Word</p>",
                                  "<div hidden>Word</div>", "<div aria-hidden=true>Word</div>", "<audio>Word</audio>", "<dialog>Word</dialog>"])
def test_article_text_stays(part):
    assert H.main_text(f"<body><article><p>{BODY}</p>{part}<p>End</p></article></body>").split("\n\n")[1:] == ["Word", "End"]


@pytest.mark.parametrize("source", ["<div>" * 20000 + "</p>" * 20000, "<span><table>" + "<b>" * 50000 + "</span>" * 50000,
                                    "<p><button>" + "<b>" * 50000 + "<hr>" * 50000, "<table>" + "<div>" * 30000 + "<td></td>" * 30000,
                                    "<ul>" + "<b>" * 40000 + "<li>x" * 40000, "<a '" * 100000, "<a \"'>" * 50000 + "<a '>\"", "<!--" * 100000,
                                    "&amp" * 200000, "<div class='ad x'>" * 40000, "<a href=x>y" * 50000])
def test_hostile_pages_take_linear_time(source):
    before = time.process_time()
    H.main_text(source)
    assert time.process_time() - before < 4


def test_operator(spark):
    rows = [(1, "u", page(f"<p>{BODY}</p>")), (2, None, None), (None, "v", ""), (1, "u", page(f"<p>{BODY}</p>"))]
    got = H.extract(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")).collect()
    want = f"Head & line\n\n{BODY.strip()}"
    assert sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in got) == sorted(
        [("1", "u", want, len(want))] * 2 + [("2", "None", "", 0), ("None", "v", "", 0)])
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_against_plain_cut(spark, sf_dir):
    """The given pages hold one article element each: its blocks, cut out plainly."""
    got = {r.page_id: r for r in H.op6(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = r.html[r.html.index("<article>") + 9:r.html.index("</article>")].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url
