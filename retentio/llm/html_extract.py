"""Operator 8: main text of HTML pages.

A page is cut into flat text blocks at block-level tags. Each block has its
word count and its link density (share of characters inside links), the
same two of its neighbours, and weaker signs: is it a heading; does it stand
in a furniture element (nav, footer, aside, form, ...) or in an article
element; do class and id names around it speak of adverts and notices, of
other furniture or of comments.
A decision tree (MLlib) trained on the small labelled table of
`html_examples.py`, most of whose pages have no telling element or name at
all, tells article blocks from the rest. The tree becomes one column
expression, so a page is parsed, judged and joined inside one narrow stage:
no shuffle.

The page is read once from left to right (`tokens`), so the cost is linear
in its length however broken it is. Scripts, styles, the head, comments and
other markup never make a block. Inside a block, white space becomes one
space and character references are decoded; blocks are joined in page order
by one line feed.

Defined cases: a null or empty html gives an empty text; plain text without
tags is one block and judged like any other; unclosed tags end with what
holds them; an unclosed quote ends with its word; a `<` with no `>` after it
is text, and a tag that the end of the page cuts off is none; rows that
repeat a page are extracted one by one.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches
from .html_examples import PAGES

#: signs of the elements around a block, as bits of an element's role
SIGNS = ["furniture", "in_article", "advert", "named", "name_part", "comments"]
FURNITURE, ARTICLE, ADVERT, NAMED, PART, COMMENTS, SKIP = (1 << i for i in range(7))
FEATURES = ["words", "link_density", "words_before", "density_before", "words_after",
            "density_after", "heading", *SIGNS]
BLOCK = "struct<text:string,x:array<double>>"

# HTML element names by the part they play.
SKIPPED = {"script", "style", "head", "template", "svg", "iframe", "textarea", "button", "canvas",
           "audio", "video", "title"}
RAW = {"script", "style", "textarea", "title", "iframe"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del",
          "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark", "q", "rp", "rt",
          "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
FURNITURE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog"}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form",
                   "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
FURNITURE_WORDS = {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer",
                   "sidebar", "aside", "login", "search", "pagination", "pager", "toolbar",
                   "masthead", "topbar"}
OTHER_WORDS = {"respond", "reply", "replies", "share", "sharing", "social", "related", "recommended",
               "recommendations", "widget", "skip", "copyright", "legal", "tags", "toc"}
ARTICLE_WORDS = {"article", "content", "post", "entry", "story", "main"}
# a name with one of these tells of the layout, not of what the element holds
QUALIFIERS = {"with", "without", "has", "no", "not"}
ADVERT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor",
                "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice",
                "popup", "modal", "overlay", "alert", "newsletter", "subscribe", "signup"}
COMMENT_WORDS = {"comment", "comments", "disqus"}
_NAMES = FURNITURE_WORDS | ADVERT_WORDS | OTHER_WORDS
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: an attribute: white space and slashes, its name, and `=` where a value follows
_ATTRIBUTE = re.compile(r"[\s/]*+([^\s/>][^\s/>=]*+)(\s*+=\s*+)?")
_UNQUOTED = re.compile(r"[^\s>]*+")
_GAP = re.compile(r"[\s/]*+")
_NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")


def _names_of(value: str) -> list[list[str]]:
    """The words of each class or id: `siteNav_main` has site, nav and main."""
    each = [[w.lower() for w in _NAME_PART.findall(name)] or [name.lower()] for name in value.split()]
    return [words for words in each if not QUALIFIERS.intersection(words)]


class Tag:
    """A start or end tag; of a repeated attribute the first counts."""

    def __init__(self, name: str, closing: bool):
        self.name, self.closing = name, closing
        self.attributes: dict[str, str] = {}
        self.self_closing = False

    def role(self, in_article: bool) -> int:
        """What the element says of its content."""
        get = self.attributes.get
        if self.name in SKIPPED or "hidden" in self.attributes \
                or get("aria-hidden", "").lower() == "true" \
                or "display:none" in get("style", "").replace(" ", "").lower():
            return SKIP
        if not self.attributes and self.name not in FURNITURE_TAGS:
            return ARTICLE if self.name in ("article", "main") else \
                FURNITURE if self.name == "header" and not in_article else 0
        names = _names_of(get("class", "")) + _names_of(get("id", ""))
        words = set().union(*names)
        role = get("role", "").lower()
        out = 0
        if self.name in FURNITURE_TAGS or role in FURNITURE_ROLES:
            out |= FURNITURE
        if (self.name == "header" or "header" in words) and not in_article:
            out |= FURNITURE
        if self.name in ("article", "main") or role in ("main", "article"):
            out |= ARTICLE
        elif self.name not in ("body", "html") and any(
                ARTICLE_WORDS.intersection(n) and not _NAMES.intersection(n) for n in names):
            out |= ARTICLE
        if self.name not in ("body", "html"):
            if words & COMMENT_WORDS:
                out |= COMMENTS
            # the last word of a name says what it is: a `site-sidebar`
            last = {n[-1] for n in names}
            if last & ADVERT_WORDS or any(ADVERT_WORDS.issuperset(n[:1]) and _NAMES.issuperset(n)
                                          for n in names):
                out |= ADVERT
            elif last & FURNITURE_WORDS:
                out |= FURNITURE
            elif last & OTHER_WORDS:
                out |= NAMED
            elif words & _NAMES:
                out |= PART
        return out


def tokens(page: str):
    """Text (str) and tags of a page, in order. Nothing is read twice: the
    search for a closing quote or comment end is not repeated where it once
    found none."""
    at, end, last_tag = 0, len(page), page.rfind(">")
    unclosed: set[str] = set()
    while at < end:
        i = page.find("<", at)
        if i < 0 or i > last_tag:
            yield page[at:]
            return
        if page.startswith("<!", i) or page.startswith("<?", i):
            if i > at:
                yield page[at:i]
            at = _after_comment(page, i)
            continue
        closing = page.startswith("/", i + 1)
        name = _NAME.match(page, i + 1 + closing)
        if name is None:
            yield page[at:i + 1]
            at = i + 1
            continue
        if i > at:
            yield page[at:i]
        tag = Tag(name[0].lower(), closing)
        at = _attributes(page, name.end(), tag, unclosed)
        if at < 0:
            return
        yield tag
        if not closing and tag.name in RAW:          # its content is no markup
            close = re.compile(f"</{re.escape(tag.name)}(?=[\\s/>])", re.I).search(page, at)
            at = close.start() if close else end


def _after_comment(page: str, i: int) -> int:
    if not page.startswith("<!--", i):
        return page.find(">", i) + 1 or len(page)
    for short in ("<!-->", "<!--->"):
        if page.startswith(short, i):
            return i + len(short)
    j = page.find("-->", i + 4)
    return j + 3 if j >= 0 else len(page)


def _attributes(page: str, at: int, tag: Tag, unclosed: set[str]) -> int:
    """Read a tag's attributes; the place after its `>`, or -1 where the
    page ends first."""
    while True:
        m = _ATTRIBUTE.match(page, at)
        if m is None:
            at = _GAP.match(page, at).end()
            tag.self_closing = page.startswith("/", at - 1)
            return at + 1 if at < len(page) else -1
        at, value = m.end(), ""
        if m[2]:
            quote = page[at:at + 1]
            if quote in ("'", '"') and quote and quote not in unclosed:
                close = page.find(quote, at + 1)
                if close >= 0:
                    value, at = page[at + 1:close], close + 1
                else:
                    unclosed.add(quote)
                    quote = ""
            else:
                quote = ""
            if not quote:
                value = _UNQUOTED.match(page, at)[0]
                at += len(value)
        tag.attributes.setdefault(m[1].lower(), value)


class _Page:
    """Collects the flat blocks of one page. Counts stand for the open
    elements, so no step looks through all of them."""

    def __init__(self):
        self.blocks: list[tuple] = []                # text, link density, heading, signs
        self.stack: list[tuple[str, int]] = []
        self.open_tags: Counter = Counter()
        self.inline: list[Counter] = [Counter()]     # open inline tags, per block element
        self.signs = [0] * 7
        self.parts: list[str] = []
        self.linked = self.headings = 0

    def text(self, raw: str) -> None:
        if self.signs[6] or not raw:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.open_tags["a"]:
            self.linked += len("".join(text.split()))

    def flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.blocks.append((text, self.linked / max(1, len(text.replace(" ", ""))),
                                    self.headings > 0, [n > 0 for n in self.signs[:6]]))
            self.parts, self.linked = [], 0

    def _count(self, name: str, role: int, step: int) -> None:
        self.open_tags[name] += step
        self.headings += step * (name in HEADINGS)
        if role:
            for i in range(7):
                self.signs[i] += step * (role >> i & 1)

    def open(self, tag: Tag) -> None:
        name = tag.name
        if name == "br":
            self.parts.append(" ")
            return
        if name not in INLINE:
            self.flush()
        if name in VOID or tag.self_closing and name in SKIPPED:
            return
        if name in ("article", "main"):
            # an article does not stand in a menu or page header: those are unclosed
            while self.open_tags["nav"] or self.open_tags["header"]:
                self._pop()
        role = tag.role(self.signs[1] > 0)
        self.stack.append((name, role))
        if name in INLINE:
            self.inline[-1][name] += 1
        else:
            self.inline.append(Counter())
        self._count(name, role, 1)

    def _pop(self) -> str:
        name, role = self.stack.pop()
        if name in INLINE:
            self.inline[-1][name] -= 1
        else:
            self.inline.pop()
        self._count(name, role, -1)
        return name

    def close(self, name: str) -> None:
        if name not in INLINE:
            self.flush()
            known = self.open_tags[name]
        else:                                        # it closes within its block only
            known = self.inline[-1][name]
        if known:
            while self._pop() != name:
                pass


def blocks_of(page: str | None) -> list[tuple[str, list[float]]]:
    """(text, features) of every flat text block, in page order."""
    out = _Page()
    for token in tokens(page or ""):
        if isinstance(token, str):
            out.text(token)
        elif token.closing:
            out.close(token.name)
        else:
            out.open(token)
    out.flush()
    around = [(0.0, 0.0), *((float(len(b[0].split())), b[1]) for b in out.blocks), (0.0, 0.0)]
    return [(text, [*around[i], *around[i - 1], *around[i + 1], float(heading), *map(float, signs)])
            for i, (text, _, heading, signs) in enumerate(out.blocks, 1)]


def block_column(html: Column) -> Column:
    """The blocks of a page: array of struct(text, x)."""
    @F.pandas_udf(f"array<{BLOCK}>")
    def blocks(pages: pd.Series) -> pd.Series:
        return pd.Series([[{"text": t, "x": x} for t, x in blocks_of(p)] for p in pages],
                         dtype=object)

    return blocks(html)


def labelled_blocks(spark: SparkSession) -> DataFrame:
    """label, x of the example blocks: those that stand between the marks
    [[ and ]] in the example pages are article text."""
    pages = spark.createDataFrame([(p,) for p in PAGES], "html string")
    block = pages.select(F.explode(block_column(F.col("html"))).alias("b"))
    return block.select(F.col("b.text").startswith("[[").cast("double").alias("label"),
                        F.col("b.x").alias("x"))


_IF = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>|in|not in) (.+)\)$")
_PREDICT = re.compile(r"^( *)Predict: (.+)$")


def tree_column(described: str, x) -> Column:
    """The column expression of MLlib's description of a fitted tree."""
    lines = [m for line in described.splitlines()
             if (m := _IF.match(line) or _PREDICT.match(line))]

    def node(at: int) -> tuple[Column, int]:
        m = lines[at]
        if m.re is _PREDICT:
            return F.lit(float(m[2])), at + 1
        yes, after = node(at + 1)          # "If" takes feature <= value
        no, after = node(after + 1)        # its "Else" line stands at `after`
        return F.when(F.get(x, F.lit(int(m[3]))) <= float(m[5]), yes).otherwise(no), after

    return node(0)[0]


def fit(spark: SparkSession) -> str:
    """Description of the tree trained on the labelled table."""
    rows = labelled_blocks(spark).select("label", array_to_vector("x").alias("features"))
    tree = DecisionTreeClassifier(maxDepth=6, minInstancesPerNode=2, seed=1)
    return tree.fit(rows.coalesce(1)).toDebugString


def extract(pages: DataFrame, tree: str | None = None, html: str = "html",
            out: str = "main_text") -> DataFrame:
    """`pages` with `out`, the main text (never null; replaced where it
    exists)."""
    bounded_batches(pages.sparkSession)
    tree = tree or fit(pages.sparkSession)
    kept = F.filter(block_column(F.col(f"`{html}`")), lambda b: tree_column(tree, b["x"]) == 1.0)
    return pages.withColumn(out, F.array_join(F.transform(kept, lambda b: b["text"]), "\n"))


def html_query(pages: DataFrame) -> DataFrame:
    out = extract(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"),
                      F.length("main_text").cast("long").alias("n_chars"))
