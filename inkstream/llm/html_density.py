"""Main text of web pages by composite text density.

A page becomes a tree of elements. For every element: C characters of text, T tags, LC characters
and LT tags of links below it. Its composite density is

    C / T * log_base(C / LC * T / LT)   with   base = ln(C / notLC * LC + LC_body / C_body * C + e)

(counts that divide are at least 1, the logarithm of the base at least ``FLAT``, which only a page
with next to no link text reaches): text per tag, lowered by links. The density sum of an element
adds the densities of its children (and of its own text). The element with the largest sum is the
core: the article element around it, if there is one, else the main element around that, else itself.

The threshold is the least density on the path from the core to the body, the body left out. Whatever
stands beside the path (children of its elements and of the body) belongs to the article if its density
reaches the threshold; headings directly before a path element belong to it. The core is taken whole, so
short paragraphs stay; only if it is no article or main element do its lists of links and nothing but links go.

Elements that are no article text by their kind (menus, site headers, footers, sidebars, forms, scripts;
``JUNK_TAGS``, ``JUNK_ROLES``) count in the body's density, but give no text. Names are a prior: a class or id
that names advert, notice, comments or the like by its last noun (reader-comments, ad-300x250, sidebar-left)
lowers a container's density to nothing, unless it holds an article or a main or, on a page without those, the
largest density sum. Names say nothing about headings, paragraphs and inline elements, nor does the id of a
section inside an article, which is an anchor. Hidden elements are text like others.

Row-local, linear in the page: a stack of open elements by tag answers what a tag closes; no recursion, so deep
nesting is safe.

Cases: null and empty html give empty text; a page without tags is one block of text; unclosed and
stray tags are repaired (a block closes an open p, li closes li, ...); unclosed comments and scripts
run to the end; character references are decoded text by text, so markup can't complete one; null ids and urls
stay; repeated rows give one result each; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from inkstream.llm.common import batch_of, read, str_texts

TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S)
ATTRIBUTE = re.compile(r"""(class|id|role)(?=[\s=>/]|\Z)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)

FLAT = 0.1

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
#: An opening tag closes the nearest open element of these, not beyond a border.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
JUNK_TAGS = frozenset("""head nav footer aside form script style noscript template iframe svg button select option
textarea input menu embed""".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar form".split())
NOTICE_ROLES = frozenset("dialog alertdialog alert".split())
JUNK_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion sidebar
comment comments commentlist respond disqus cookie cookies consent gdpr notice notices alert banner popup modal overlay
newsletter subscribe subscription signup menu nav navbar navigation breadcrumb breadcrumbs footer masthead share sharing
social related recommended login search toolbar pagination pager skip""".split())
#: Words after a junk name that leave it the name of a block.
FORMS = frozenset("""area articles bar block body box btn button buttons container footer form header icons info inner item
items law left links list main media message module outer panel posts primary right secondary section site slot space
stories text thread top bottom unit widget widgets wrap wrapper zone""".split())
COMMENTS = frozenset("comment comments commentlist respond disqus".split())
SIZE = re.compile(r"\d+(?:x\d+)?")
STATE = re.compile(r"(?:has|with|no|is|without|show|hide)[-_]|.*[-_](?:open|closed|on|off|enabled|disabled)$")
SITE_HEADER = frozenset("header site-header page-header top-header global-header main-header".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that names say nothing about.
UNNAMED = HEADINGS | frozenset("html body main article p li dd dt td th tr pre blockquote figcaption caption legend summary address".split())
LISTS = frozenset("ul ol div section table dl menu".split())
BORDERS = ("table", "article", "main", "body")


def junk(tag: str, attributes: str, in_article: bool) -> bool:
    """No article text by its tag or role."""
    if tag in JUNK_TAGS or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    roles = {value.strip("\"'").lower() for name, value in ATTRIBUTE.findall(attributes) if name.lower() == "role"}
    return bool(roles & JUNK_ROLES) or not in_article and bool(roles & NOTICE_ROLES)


def junk_word(word: str) -> bool:
    """Its last noun, sizes, numbers and words for boxes aside, is that of a block that is no article text."""
    if word in JUNK_NAMES:
        return True
    parts = [p for p in re.split(r"[-_]+", word) if p and not SIZE.fullmatch(p)]
    while len(parts) > 1 and parts[-1] in FORMS and parts[-1] not in JUNK_NAMES:
        parts.pop()
    return bool(parts) and parts[-1] in JUNK_NAMES


def junk_name(tag: str, attributes: str, in_article: bool) -> bool:
    """The name of a block that is no article text."""
    if not attributes or tag not in BLOCK or tag in UNNAMED:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id"):
            words = value.strip("\"'").lower().split()
            if not in_article and any(w in SITE_HEADER for w in words):
                return True
            if name == "id" and tag == "section" and in_article:
                words = [w for w in words if w in COMMENTS]
            # has-sidebar, with-ads, comments-open say something about the page, not what the element is
            if any(junk_word(w) for w in words if not STATE.match(w)):
                return True
    return False


class Page:
    """The element tree of a page in page order, and its texts with the element each stands in."""

    def __init__(self, source: str):
        self.tag, self.parent, self.end = ["#root"], [-1], [0]
        self.junk, self.named, self.link, self.article = [False], [False], [False], [False]
        #: (element, text); text None marks the border of a block
        self.texts: list[tuple[int, str | None]] = []
        #: depths in the stack of the open elements: by tag, and of those that a block can't look beyond
        self.open_at: dict[str, list[int]] = defaultdict(list)
        self.edges: list[int] = []
        stack, at, n = [0], 0, len(source)
        while at < n:
            m = TOKEN.search(source, at)
            if m is None:
                self._text(stack[-1], source[at:])
                break
            if m.start() > at:
                self._text(stack[-1], source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._close(stack, name)
            else:
                self._open(stack, name, m[3] or m[6] or "")
                if name in RAW:
                    stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
                    at = stop.start() if stop else n
        while stack:
            self.end[stack.pop()] = len(self.tag)
        if any(self.named):
            self._judge_names()

    def _judge_names(self) -> None:
        """Elements with the name of junk are junk, but for those that hold the article."""
        n = len(self.tag)
        holds = [self.tag[k] in ("article", "main") and not self.junk[k] and not self.named[k] for k in range(n)]
        if not any(holds):
            skipped = [a or b for a, b in zip(self.junk, self.named)]
            each, total, body = self.densities(skipped)
            blocks = {self.parent[k] for k in range(1, n) if each[k] > 0 and self.tag[k] in BLOCK and not skipped[k]}
            best = max((k for k in blocks if not skipped[k] and body <= k < self.end[body]),
                       key=lambda k: (total[k], -k), default=None)
            if best is not None:
                holds[best] = True
        for k in range(n - 1, 0, -1):
            if holds[k]:
                holds[self.parent[k]] = True
        for k in range(1, n):
            self.junk[k] = self.junk[k] or self.junk[self.parent[k]] or self.named[k] and not holds[k]

    def _text(self, node: int, text: str) -> None:
        text = html.unescape(text)
        if not text.isspace():
            self.texts.append((node, text))
        elif self.texts and self.texts[-1][1] is not None:
            self.texts.append((node, " "))

    def _pop(self, stack: list[int], depth: int) -> None:
        for node in reversed(stack[depth:]):
            self.end[node] = len(self.tag)
            self.open_at[self.tag[node]].pop()
            if self.tag[node] in BLOCK:
                self.texts.append((node, None))
        del stack[depth:]
        while self.edges and self.edges[-1] >= depth:
            self.edges.pop()

    def _nearest(self, tags) -> int:
        """Depth of the innermost open element of these tags; 0: none."""
        return max((self.open_at[t][-1] for t in tags if self.open_at[t]), default=0)

    def _close(self, stack: list[int], name: str) -> None:
        depth = self._nearest((name,))
        if depth and (name in BLOCK or self._nearest(BORDERS) <= depth):
            self._pop(stack, depth)

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        if name in BLOCK and self.edges and self.tag[stack[self.edges[-1]]] == "p":
            self._pop(stack, self.edges[-1])                 # a block closes an open paragraph
        closes, border = CLOSES.get(name, ((), ()))
        while closes and (depth := self._nearest(closes)) > self._nearest(border):
            tag = self.tag[stack[depth]]
            self._pop(stack, depth)
            if name != "tr" or tag == "tr":
                break
        if name == "body" and self.open_at["head"]:          # an unclosed head ends here
            self._pop(stack, self.open_at["head"][0])
        top, node = stack[-1], len(self.tag)
        self.tag.append(name)
        self.parent.append(top)
        self.end.append(node + 1)
        self.link.append(self.link[top] or name == "a")
        self.article.append(self.article[top] or name in ("article", "main"))
        self.junk.append(self.junk[top] or junk(name, attributes, self.article[top]))
        self.named.append(junk_name(name, attributes, self.article[top]))
        if name in BLOCK:
            self.texts.append((node, None))
        elif name == "br":
            self.texts.append((top, " "))
        if name not in VOID:
            self.open_at[name].append(len(stack))
            if name in BLOCK or name == "button":
                self.edges.append(len(stack))
            stack.append(node)

    def densities(self, skipped: list[bool] | None = None) -> tuple[list[float], list[float], int]:
        """Composite density and density sum of each element, and the body; sums without the ``skipped``
        elements (junk)."""
        skipped = self.junk if skipped is None else skipped
        n = len(self.tag)
        chars, tags, link_chars, link_tags, own = ([0] * n for _ in range(5))
        for node, text in self.texts:
            if text is not None and self.tag[node] not in RAW:
                size = len(" ".join(text.split()))
                chars[node] += size
                own[node] += size
                if self.link[node]:
                    link_chars[node] += size
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            chars[p] += chars[k]
            tags[p] += tags[k] + 1
            link_chars[p] += link_chars[k]
            link_tags[p] += link_tags[k] + (self.tag[k] == "a")
        body = next((k for k in range(n) if self.tag[k] == "body"), 0)
        ratio = link_chars[body] / max(1, chars[body])

        def density(c, t, lc, lt):
            if not c:
                return 0.0
            base = math.log(c / max(1, c - lc) * lc + ratio * c + math.e)
            adjusted = math.log(max(c / max(1, lc) * max(1, t) / max(1, lt), 1.0)) + 0.01
            return c / max(1, t) * adjusted / max(math.log(base), FLAT)

        each = [density(*x) for x in zip(chars, tags, link_chars, link_tags)]
        total = [density(own[k], 1, own[k] if self.link[k] else 0, 1) for k in range(n)]
        for k in range(n - 1, 0, -1):
            if not skipped[k]:
                total[self.parent[k]] += each[k]
        return each, total, body

    def chosen(self) -> tuple[int, list[int]]:
        """The core (-1: none) and the elements, itself first, whose subtrees are the article."""
        each, total, body = self.densities()
        stop = self.end[body]
        best = max((k for k in range(body, stop) if not self.junk[k]), key=lambda k: (total[k], -k), default=-1)
        if best < 0 or total[best] <= 0:
            return -1, []
        while best != body and self.tag[best] not in BLOCK - UNNAMED | {"article", "main"}:
            best = self.parent[best]                         # inline elements and paragraphs are parts of a block
        path = [best]
        while path[-1] > body:
            path.append(self.parent[path[-1]])
        for tag in ("article", "main"):
            around = [k for k in path if self.tag[k] == tag]
            if around:
                path = path[path.index(around[-1]):]
                break
        core = path[0]
        if core == body:
            return core, [core]
        threshold = min(each[k] for k in path if k != body)
        on_path, out, before = set(path), [core], []
        beside = defaultdict(list)
        for k in range(body + 1, stop):
            if self.parent[k] in on_path and self.parent[k] != core:
                beside[self.parent[k]].append(k)
        for above in path[1:]:
            before = []                                      # headings since the last other element
            for k in beside[above]:
                if k in on_path:
                    out += before
                elif not self.junk[k]:
                    if self.tag[k] in HEADINGS:
                        before.append(k)
                    else:
                        before = []
                    if each[k] >= threshold:
                        out.append(k)
        return core, list(dict.fromkeys(out))

    def _only_links(self, core: int) -> set[int]:
        """Children of a core without a meaning of its own that are lists of links and nothing else."""
        if core < 0 or self.tag[core] in ("article", "main"):
            return set()
        within, plain, links, child = set(), set(), defaultdict(set), {}
        for k in range(core + 1, self.end[core]):
            child[k] = k if self.parent[k] == core else child[self.parent[k]]
            if self.tag[k] == "a":
                links[child[k]].add(k)
        for node, text in self.texts:
            if text is not None and node in child and not text.isspace():
                within.add(child[node])
                if not self.link[node]:
                    plain.add(child[node])
        least = 1 if self.tag[core] in ("body", "html", "#root") else 2
        return {k for k in within - plain if self.tag[k] in LISTS and len(links[k]) >= least}

    def main_text(self) -> str:
        core, roots = self.chosen()
        if core < 0:
            return ""
        n, blocks, now = len(self.tag), [], []
        left_out = self._only_links(core)
        inside = [False] * n
        for k in sorted(roots):                              # a root may hold another's end, never a part of it
            inside[k] = True
        for k in range(1, n):
            inside[k] = (inside[k] or inside[self.parent[k]]) and k not in left_out
        for node, text in [*self.texts, (core, None)]:
            if text is None:
                if now:
                    block = " ".join("".join(now).split())
                    if block:
                        blocks.append(block)
                    now = []
            elif inside[node] and not self.junk[node]:
                now.append(text)
        return "\n\n".join(blocks)


def main_text(source: str) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars``."""
    own = pages.select(id_col, url_col, html_col)
    schema = T.StructType([*own.schema.fields[:2], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(t) for t in str_texts(batch.column(2))]
            yield batch_of(schema, [batch.column(0), batch.column(1), pa.array(texts, pa.string()), list(map(len, texts))])

    return own.mapInArrow(run, schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))
