"""Article extraction from raw HTML pages and URLs (S8, S9, S10), as native column expressions.

The reference parses pages with a DOM library on one machine. Here each page is a row and the
extraction is a fixed set of regular expressions over it (own contract, stated per function), so
pages are processed in parallel and whole, with no per-row Python.

Contract shared by S8/S9: S8 reads every ``<article>`` element of a page, S9 the first; a block (``<p>``, ``<h1>``,
``<h2>``) starts at its opening tag and ends at its closing tag, at the next block start, or at the
end of the article (so unclosed ``<p>`` tags work); block text is the markup with tags removed
and character references decoded (``REFERENCE``, ``NAMES``). Tag and attribute names match in any case.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkstream.functions.dates import parse_date, parse_date_sql
from inkstream.functions.text import _q, py_strip, py_strip_sql

ARTICLE = r"(?si)<article(?:\s[^>]*)?>(.*?)</article>"
H1 = r"(?si)<h1(?:\s[^>]*)?>(.*?)</h1>"
SUMMARY_DIV = r"(?si)</h1>\s*<div(?:\s[^>]*)?>(.*?)</div>"
TIME_ATTR = r"(?i)<time[^>]*\sdatetime=\"([^\"]*)\""
P_OPEN = r"(?i)<p(?:\s[^>]*)?>"
P_CLOSE = r"(?i)</p>"
BLOCK_OPEN = r"(?i)<(?:h1|h2|p)(?:\s[^>]*)?>"
BLOCK_CLOSE = r"(?i)</(?:h1|h2|p)>"
TAG = r"<[^>]+>"
AD_MARKER = "Advertisement"
URL_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"
# Character references that are decoded: by code point (decimal or hex) and by these names: the Latin-1 letters and
# signs, mark-up characters, and common punctuation. &nbsp; is a plain space here.
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,7});"
_MORE = "lt gt quot apos amp ndash mdash lsquo rsquo ldquo rdquo hellip bull euro trade".split()
NAMES = {n[:-1]: c for n, c in sorted(html5.items()) if n.endswith(";") and len(c) == 1 and len(n) <= 9
         and ("\xa1" <= c <= "\xff" or n[:-1] in _MORE)} | {"nbsp": " "}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_entities(c) -> Column:
    """Character references decoded in one pass, so that ``&amp;lt;`` becomes ``&lt;``. A text with an ampersand is cut
    at its references, each is looked up, and the pieces are joined again. Names that aren't known and code points
    that no text may hold stay as they are."""
    x = _c(c)
    refs = F.transform(F.regexp_extract_all(x, F.lit(REFERENCE), F.lit(0)), _reference)
    decoded = F.concat(refs, F.array(F.lit("")))                     # nothing follows the last piece
    pieces = F.zip_with(F.split(x, REFERENCE, -1), decoded, lambda t, r: F.concat(t, r))
    return F.when(F.contains(x, F.lit("&")), F.array_join(pieces, "")).otherwise(x)


def _reference(ref: Column) -> Column:
    digits = F.regexp_extract(ref, "^&#([0-9]+);$", 1)
    hexed = F.regexp_extract(ref, "^&#[xX]([0-9a-fA-F]+);$", 1)
    code = F.when(digits != "", digits.cast("int")).when(hexed != "", F.conv(hexed, 16, 10).cast("int"))
    fine = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    name = F.substring(ref, F.lit(2), F.char_length(ref) - 2)
    names = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    return F.coalesce(F.when(fine, letter), F.try_element_at(names, name), ref)


def decode_entities_sql(e: str) -> str:
    names = ", ".join(f"{_q(n)}: {_q(c)}" for n, c in NAMES.items())
    code = ("coalesce(try_cast(nullif(regexp_extract(r, '^&#([0-9]+);$', 1), '') AS INT), "
            "try_cast('0x' || nullif(regexp_extract(r, '^&#[xX]([0-9a-fA-F]+);$', 1), '') AS INT))")
    fine = f"{code} BETWEEN 1 AND 1114111 AND NOT {code} BETWEEN 55296 AND 57343"
    one = (f"lambda r: CASE WHEN {fine} THEN chr({code}) ELSE coalesce(MAP {{{names}}}[substr(r, 2, length(r) - 2)], r) END")
    refs = f"list_transform(regexp_extract_all({e}, {_q(REFERENCE)}), {one})"
    return (f"CASE WHEN contains({e}, '&') THEN array_to_string(list_transform(list_zip(regexp_split_to_array({e}, {_q(REFERENCE)}), "
            f"list_append({refs}, '')), lambda z: z[1] || z[2]), '') ELSE {e} END")


def block_text(c) -> Column:
    return decode_entities(F.regexp_replace(_c(c), TAG, ""))


def block_text_sql(e: str) -> str:
    return decode_entities_sql(f"regexp_replace({e}, {_q(TAG)}, '', 'g')")


def article_body(html) -> Column:
    return F.regexp_extract(_c(html), ARTICLE, 1)


def article_bodies(html) -> Column:
    """The bodies of all <article> elements of a page, in order."""
    return F.regexp_extract_all(_c(html), F.lit(ARTICLE), 1)


def article_body_sql(e: str) -> str:
    return f"regexp_extract({e}, {_q(ARTICLE)}, 1)"


def _blocks(body: Column, open_re: str, close_re: str) -> Column:
    parts = F.split(body, open_re)
    tail = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(tail, lambda x: block_text(F.split(x, close_re).getItem(0)))


def _blocks_sql(body: str, open_re: str, close_re: str) -> str:
    return (f"list_transform(regexp_split_to_array({body}, {_q(open_re)})[2:], "
            f"lambda x: {block_text_sql(f'regexp_split_to_array(x, {_q(close_re)})[1]')})")


def extract_article(body):
    """(title, summary, published_at, content) of one <article> body (see ``article_bodies``).

    title: h1 text, stripped. summary: text of a <div> right after the h1, null when absent.
    published_at: ``time@datetime`` parsed to YYYY-MM-DD (null when absent or unparsable).
    content: texts of the <p> blocks without an "Advertisement" one, joined by one space.
    """
    body = _c(body)
    title = py_strip(block_text(F.regexp_extract(body, H1, 1)))
    summary = F.nullif(py_strip(block_text(F.regexp_extract(body, SUMMARY_DIV, 1))), F.lit(""))
    published = parse_date(F.nullif(F.regexp_extract(body, TIME_ATTR, 1), F.lit("")))
    paras = F.filter(_blocks(body, P_OPEN, P_CLOSE), lambda t: ~t.contains(AD_MARKER))
    content = F.array_join(paras, " ")
    return title.alias("title"), summary.alias("summary"), published.alias("published_at"), content.alias("content")


def extract_article_sql(body: str) -> str:
    title = py_strip_sql(block_text_sql(f"regexp_extract({body}, {_q(H1)}, 1)"))
    summary = f"NULLIF({py_strip_sql(block_text_sql(f'regexp_extract({body}, {_q(SUMMARY_DIV)}, 1)'))}, '')"
    published = parse_date_sql(f"NULLIF(regexp_extract({body}, {_q(TIME_ATTR)}, 1), '')")
    paras = f"list_filter({_blocks_sql(body, P_OPEN, P_CLOSE)}, lambda t: NOT contains(t, '{AD_MARKER}'))"
    return (f"{title} AS title, {summary} AS summary, {published} AS published_at, "
            f"array_to_string({paras}, ' ') AS content")


def block_text_join(html) -> Column:
    """h1, h2 and p block texts of the article in document order, each stripped, space-joined."""
    blocks = _blocks(article_body(html), BLOCK_OPEN, BLOCK_CLOSE)
    return F.array_join(F.transform(blocks, lambda t: py_strip(t)), " ")


def block_text_join_sql(html: str) -> str:
    blocks = _blocks_sql(article_body_sql(html), BLOCK_OPEN, BLOCK_CLOSE)
    return f"array_to_string(list_transform({blocks}, lambda t: {py_strip_sql('t')}), ' ')"


def url_topic_title(url):
    """Path parts split on '/': part 2 is the topic, the second-last the title ('-' -> ' ')."""
    parts = F.split(F.regexp_extract(_c(url), URL_PATH, 1), "/")
    topic = F.try_element_at(parts, F.lit(3))
    title = F.replace(F.try_element_at(parts, F.lit(-2)), F.lit("-"), F.lit(" "))
    return topic.alias("topic"), title.alias("title")


def url_topic_title_sql(url: str) -> str:
    parts = f"string_split(regexp_extract({url}, {_q(URL_PATH)}, 1), '/')"
    return f"{parts}[3] AS topic, replace({parts}[-2], '-', ' ') AS title"
