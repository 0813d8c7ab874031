"""Main text of web pages, without what a site repeats on every page.

A page is read into element subtrees.  Every block element gets a hash of its
tags and text.  Spark counts, per host, in how many different pages each hash
occurs; pages with the same text besides the subtree count as one, so copies
of a page don't turn its article into a template.  Subtrees found in ``MIN_PAGES``
or more pages of a host, and in ``MIN_SHARE`` of its different pages, are
deleted, and so is what its tag, role or class marks as not being the article.
Nothing else of an article element is taken for a template, nor are paragraphs
and headings of a main element: short ones may recur by chance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tintero.llm.common import BROADCAST_BYTES, join_small, ship_package, text_or_empty
from tintero.session import materialize

MIN_PAGES = 10
#: Part of the host's different pages that a template is found in at least.
MIN_SHARE = 0.1
#: Outside an article, paragraphs shorter than this are never templates.
MIN_CHARS = 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that are never part of an article.
_ASIDE = frozenset(
    "nav header footer aside form script style noscript template iframe svg math canvas object button select textarea "
    "input dialog menu head title noembed noframes xmp audio video map".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
#: Words in a class or id that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|sidebar|side-?bar|aside|footer|header|masthead|ad|ads|advert\w*|adsense|"
    r"banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|"
    r"subscri\w*|share|sharing|social|related|recommend\w*|breadcrumbs?|comments?|commentlist|reply|replies|respond|"
    r"disqus|pagination|pager|widget|toolbar|login|signup|search)(?:$|[\s_-])",
    re.IGNORECASE,
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
_ROOTS = ("article", "main")
#: What the start of a tag closes: these tags, up to the nearest of the others.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}


def _aside(tag: str, attributes: str) -> bool:
    """Whether the tag and its attributes mark something else than the article."""
    if tag in _ASIDE:
        return True
    if len(attributes) < 3 or tag in ("html", "body", "main"):
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    return (
        "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
        or found.get("role", "").lower() in _ROLES
        or bool(_MARKED.search(found.get("class", "")) or _MARKED.search(found.get("id", "")))
        or bool(_HIDDEN.search(found.get("style", "")))
    )


class _Element:
    __slots__ = ("aside", "block", "parts", "root", "subtree", "tag")

    def __init__(self, tag: str, aside: bool, root: int, subtree: int):
        self.tag, self.aside, self.root, self.subtree = tag, aside, root, subtree
        self.block, self.parts = tag not in _INLINE, []


class Page:
    """A page as text blocks and block subtrees.

    ``blocks`` are (text, subtrees it lies in, number of the content root or -1);
    ``subtrees`` are (tag, content root, hash, characters).
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, tuple[int, ...], int]] = []
        self.subtrees: list[tuple[str, int, int, int]] = []
        self.roots: list[str] = []
        self._stack = [_Element("", False, -1, -1)]
        self._text: list[str] = []
        self._asides = 0
        self._read(html)

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text.clear()
            if text:
                top = next(e for e in reversed(self._stack) if e.block)
                top.parts.append(text)
                if not self._asides:
                    inside = tuple(e.subtree for e in self._stack if e.subtree >= 0)
                    self.blocks.append((text, inside, self._stack[-1].root))

    def _open(self, tag: str, attributes: str) -> None:
        if tag not in _INLINE:
            self._flush()
            self._close_implied(tag)
        aside = _aside(tag, attributes)
        root = self._stack[-1].root
        if tag in _ROOTS and not aside and (root < 0 or (tag == "article" and self.roots[root] == "main")):
            self.roots.append(tag)
            root = len(self.roots) - 1
        subtree = -1
        if tag not in _INLINE and tag not in ("html", "body", "head"):
            subtree = len(self.subtrees)
            self.subtrees.append((tag, root, 0, 0))
        self._stack.append(_Element(tag, aside, root, subtree))
        self._asides += aside

    def _close_implied(self, tag: str) -> None:
        closed, borders = _CLOSES.get(tag, (("p",), ("td", "th", "li", "dd", "blockquote", "div", "section", "article", "main", "body")))
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self._stack[depth].tag
            if name in closed:
                self._close_to(depth)
            elif name in borders:
                break

    def _close_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            if self._stack[-1].block:
                self._flush()
            element = self._stack.pop()
            self._asides -= element.aside
            if element.subtree >= 0:
                content = f"{element.tag}\n" + "\n".join(element.parts)
                value = xxh64_intdigest(content.encode("utf-8", "replace"))
                tag, root, _, _ = self.subtrees[element.subtree]
                self.subtrees[element.subtree] = (tag, root, value, len(content) - len(tag))
                top = next(e for e in reversed(self._stack) if e.block)
                top.parts.append(f"<{value:x}>")

    def _end(self, tag: str) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            element = self._stack[depth]
            if element.tag == tag:
                if element.block:
                    self._flush()
                self._close_to(depth)
                return
            if tag in _INLINE and element.block:
                return

    def _read(self, html: str) -> None:
        at, text = 0, self._text
        find = _TOKEN.search
        while token := find(html, at):
            if token.start() > at:
                part = html[at : token.start()]
                text.append(unescape(part) if "&" in part else part)
            at = token.end()
            name = token[3]
            if name is None:
                if token[1]:
                    text.append(token[1])
                continue
            tag = name.lower()
            if token[2]:
                self._end(tag)
            elif tag in _VOID:
                if tag in _INLINE:
                    text.append(" " if tag in ("br", "wbr", "img") and tag != "wbr" else "")
                else:
                    self._flush()
            elif tag in _RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
                if tag not in _INLINE:
                    self._flush()
                at = end.end() if end else len(html)
            else:
                self._open(tag, token[4])
        if at < len(html):
            part = html[at:]
            text.append(unescape(part) if "&" in part else part)
        self._flush()
        self._close_to(1)

    def contents(self) -> tuple[int, dict[int, int]]:
        """A hash of all blocks, and by subtree hash one of those outside such subtrees where that differs."""
        whole, inside = 0, {}
        for text, subtrees, _ in self.blocks:
            value = xxh64_intdigest(text.encode("utf-8", "replace"))
            whole += value
            for h in {self.subtrees[i][2] for i in subtrees}:
                inside[h] = inside.get(h, 0) + value
        mask = (1 << 63) - 1
        return whole & mask, {h: whole - part & mask for h, part in inside.items()}

    def _in_article(self, root: int) -> bool:
        return root >= 0 and self.roots[root] == "article"

    def _may_recur(self, tag: str, root: int, size: int) -> bool:
        if self._in_article(root):
            return False
        if tag in _PARAGRAPHS:
            return root < 0 and size >= MIN_CHARS
        return tag not in _ROOTS

    def _recurring(self) -> set[int]:
        return {h for tag, root, h, size in self.subtrees if size and self._may_recur(tag, root, size)}

    def candidates(self, host: str) -> set[int]:
        """Hashes, by host, of the subtrees that would be deleted if they recurred."""
        return {_of_host(host, h) for h in self._recurring()}

    def counted(self, host: str) -> Iterator[tuple[int | None, int]]:
        """(hash by host, content of the page besides it) of those subtrees, and of none."""
        whole, besides = self.contents()
        yield None, whole
        for h in self._recurring():
            yield _of_host(host, h), besides.get(h, whole)

    def text(self, host: str, templates: set[int] | frozenset[int]) -> str:
        gone = {
            i
            for i, (tag, root, h, size) in enumerate(self.subtrees)
            if size and templates and self._may_recur(tag, root, size) and _of_host(host, h) in templates
        }
        blocks = [(t, root) for t, inside, root in self.blocks if self._in_article(root) or gone.isdisjoint(inside)]
        if self.roots:
            sizes = [0] * len(self.roots)
            for t, root in blocks:
                if root >= 0:
                    sizes[root] += len(t)
            articles = [i for i, tag in enumerate(self.roots) if tag == "article" and sizes[i]]
            if articles:
                best = max(articles, key=sizes.__getitem__)
                blocks = [(t, root) for t, root in blocks if root == best]
            elif any(sizes):
                blocks = [(t, root) for t, root in blocks if root >= 0]
        return "\n".join(t for t, _ in blocks)


def _of_host(host: str, value: int) -> int:
    found = xxh64_intdigest(f"{host}\n{value:x}".encode("utf-8", "replace"))
    return found - (1 << 64) if found >> 63 else found


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        hosts, hashes, contents = [], [], []
        for url, html in zip(batch["url"], batch["html"]):
            page, host = Page(html), host_of(url)
            found = list(page.counted(host))
            hosts.extend([_of_host(host, 0)] * len(found))
            hashes.extend(h for h, _ in found)
            contents.extend(content for _, content in found)
        yield pd.DataFrame({
            "host": pd.Series(hosts, dtype="int64"), "h": pd.Series(hashes, dtype="Int64"),
            "content": pd.Series(contents, dtype="int64"),
        })


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(h): hashes, by host, of the subtrees in ``min_pages`` and ``min_share`` of the host's different pages or more."""
    rows = pages.select("url", text_or_empty("html").alias("html"))
    found = rows.mapInPandas(_candidates, "host long, h long, content long").distinct()
    counts = found.groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("h").isNull() | (F.col("n") >= min_pages))
    counts = materialize(counts, "subtree-counts")
    hosts = counts.where("h IS NULL").select("host", F.col("n").alias("pages"))
    often = join_small(counts.where("h IS NOT NULL"), hosts, ["host"], "inner", 24)
    return often.where(F.col("n") >= F.col("pages") * F.lit(min_share)).select("h")


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, limit: int = BROADCAST_BYTES) -> DataFrame:
    r"""(page_id, url, text) for each row of ``pages(page_id, url, html)``.

    ``text`` is the article's blocks in page order, one per line: the largest
    article element, else main, else what is left of the body.  Character
    references are decoded; white space in a block is one blank.  A null or
    empty html gives an empty text, a null or odd url counts as one host
    without a name.  Repeated rows stay repeated and count as one page; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    ship_package(spark)
    recurring = materialize(templates(pages, min_pages), "templates")
    rows = pages.select("page_id", "url", text_or_empty("html").alias("html"))
    if recurring.count() * 8 <= limit:
        known = spark.sparkContext.broadcast(frozenset(r.h for r in recurring.collect()))

        @F.pandas_udf("string")
        def main_text(urls: pd.Series, htmls: pd.Series) -> pd.Series:
            return pd.Series([Page(h).text(host_of(u), known.value) for u, h in zip(urls, htmls)], dtype=object)

        return rows.select("page_id", "url", main_text("url", "html").alias("text"))

    @F.pandas_udf("array<long>")
    def hashes(urls: pd.Series, htmls: pd.Series) -> pd.Series:
        return pd.Series([sorted(Page(h).candidates(host_of(u))) for u, h in zip(urls, htmls)])

    @F.pandas_udf("string")
    def text_without(urls: pd.Series, htmls: pd.Series, gone: pd.Series) -> pd.Series:
        each = zip(urls, htmls, gone)
        return pd.Series([Page(h).text(host_of(u), frozenset(() if g is None else g)) for u, h, g in each], dtype=object)

    key = F.xxhash64("url", "html").alias("page")
    held = rows.select(key, F.explode(hashes("url", "html")).alias("h")).distinct()
    own = held.join(recurring, "h").groupBy("page").agg(F.collect_list("h").alias("gone"))
    joined = rows.withColumn("page", key).join(own, "page", "left")
    return joined.select("page_id", "url", text_without("url", "html", "gone").alias("text"))
