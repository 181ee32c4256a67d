"""Main text of web pages by tag-path ratios.

A page is cut into leaves of text, each with the path of block elements (tag, classes and id) from the
root to it. For each path of the page, text length, punctuation marks and link text are summed over
its leaves. The two ratios, characters a leaf and marks a leaf, are smoothed over the paths that
stand beside it in page order, the nearer in the tree the more, fused by their geometric mean, and
weighted: by the share of text outside links, and by what the path's elements say they are. A
threshold relative to the page's best path selects the content paths.

What elements say weighs and never decides alone. A menu, footer, advert, form, ... (by its tag, or by a
whole class or id) weighs ``SIDE``, a form ``FORM``; a name that only holds such a word (``share-price``) weighs ``HINT``; where a
page declares its article, what stands outside weighs ``SIDE``. So a page that stands in one form as a
whole keeps its text, as its best path weighs as little. Invisible elements, and menus, footers and
asides by their tag, have no text of the article.

The content subtree, the smallest container with most of the selected text (the declared article,
where there is one), is then completed: its short cells, list items, headings, links and formulas stay
although their own ratios are low, but side matter inside it and, in undeclared pages, paths of
nothing but links do not. Content paths outside it stay. Leaves in page order are the text.

Each page is one row, so nothing is shuffled. Cases: null, empty or text-free html gives an empty
text, and so does an empty declared article among side matter; unclosed and misnested elements are
closed as browsers do, and elements nested deeper than ``DEEPEST`` are taken as siblings; truncated pages
are read to their end; very long pages are read whole; repeated rows give equal rows; an empty table
gives an empty result; other columns, also of the result's names, are not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from math import prod, sqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded, steps

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)", re.S)
REST = re.compile(r"""[^"'>]*(?:(?:"[^"]*"|'[^']*')[^"'>]*)*>""")
NAMED = re.compile(r"""\b(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
#: Elements whose content is not text, or not the page's.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "object", "canvas", "audio", "video", "title", "xmp", "noembed", "noframes", "annotation", "annotation-xml"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "mspace"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
    "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "mover", "munder", "munderover", "mfenced", "mstyle", "mtable", "mtr", "mtd",
}
#: Opening one of these closes an open one of those above it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = {"ul", "ol", "dl", "table", "div", "section", "article", "body", "select"}
#: Elements that can hold a page's content as a whole.
CONTAINERS = {"html", "body", "div", "section", "article", "main", "center", "form", "table", "tbody", "tr", "td"}
DEEPEST = 512
#: Elements that are never main text, and those that seldom are.
NEVER_TAGS = {"nav", "footer", "aside", "menu", "head", "button", "select", "dialog"}
SIDE_TAGS = {"form", "fieldset"}
#: Name parts of side matter; those that say no more beside one; those that turn it around.
SIDE_NAMES = {
    "ad", "ads", "advert", "advertisement", "adverts", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "reply", "replies",
    "respond", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
PLAIN_NAMES = {
    "area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form", "global", "group", "icons", "inner", "item", "left", "link", "links", "list", "main", "media", "module", "news", "outer",
    "page", "panel", "posts", "primary", "reader", "right", "row", "secondary", "section", "signup", "site", "slot", "stories", "text", "thread", "title", "top", "unit", "user", "wrap", "wrapper", "zone",
}
TURNED_NAMES = {"closed", "disabled", "enabled", "has", "is", "no", "off", "on", "open", "with", "without"}
ARTICLE_NAMES = {"article", "hentry", "entry-content", "post-content", "article-body", "article-content", "post-body", "story-body"}
MAIN_NAMES = {"main", "articlebody"}
FORM, SIDE, HINT, LEAST = 0.02, 0.002, 0.6, 0.1
#: Mean characters a leaf at least, for text in a page that is side matter as a whole.
PROSE = 80
#: Share of a container's selected text that one child must hold to be the content in its place.
MOST = 0.8
MARKS = re.compile(r"[.,;:!?…。、，！？；：]")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Element(NamedTuple):
    tag: str
    name: str  # with its classes and id, less digits
    weight: float
    main: bool


class Leaf(NamedTuple):
    path: tuple[Element, ...]
    nodes: tuple[int, ...]  # the path's elements, numbered in page order
    text: str
    links: int  # characters in links


def _said(words: list[str]) -> float:
    """The weight of classes, ids and roles."""
    weight = 1.0
    for word in words:
        parts = {p.lower() for p in PART.findall(word) if not p.isdigit()}
        if parts & SIDE_NAMES and not parts & TURNED_NAMES:
            weight = min(weight, SIDE if parts <= SIDE_NAMES | PLAIN_NAMES else HINT)
    return max(weight, HINT) if any(w.lower() in ARTICLE_NAMES for w in words) else weight


def _element(tag: str, attributes: str, inside_main: bool) -> Element:
    weight, main, words = 1.0, tag in ("article", "main"), []
    if tag in NEVER_TAGS:
        weight = 0.0
    elif tag in SIDE_TAGS or (tag == "header" and not inside_main):
        weight = FORM
    if attributes.strip(" /"):
        for name, value in NAMED.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                weight = 0.0
            elif name in ("class", "id", "role") and tag not in ("html", "body", "main"):
                words += value.split()
            if (name == "role" and value.lower() == "main") or (name == "itemprop" and value.lower() in MAIN_NAMES):
                main = True
        weight *= _said(words)
    return Element(tag, ".".join([tag, *(re.sub(r"\d+", "", w) for w in words)]), weight, main and weight >= HINT)


def leaves(page: str) -> tuple[list[Leaf], bool]:
    """The page's leaves in order, and whether it declares an article."""
    out: list[Leaf] = []
    path: list[Element] = []
    nodes: list[int] = []
    text: list[str] = []
    links = in_link = made = 0
    declared = False

    def flush() -> None:
        nonlocal links
        if text:
            if t := " ".join(html.unescape("".join(text)).split()):
                out.append(Leaf(tuple(path), tuple(nodes), t, min(links, len(t))))
            text.clear()
        links = 0

    def add(s: str) -> None:
        nonlocal links
        if s:
            text.append(s)
            if in_link:
                links += len(s)

    def cut(k: int) -> None:
        del path[k:], nodes[k:]

    pos, n = 0, len(page)
    while pos < n:
        m = MARKUP.search(page, pos)
        if not m:
            add(page[pos:])
            break
        add(page[pos : m.start()])
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        end = REST.match(page, pos)
        stop = end.end() if end else page.find(">", pos) + 1 or n
        attributes, pos = page[pos : stop - 1], stop
        if m[1]:  # an end tag
            if tag == "a":
                in_link = 0
            elif tag not in INLINE and tag not in VOID:
                flush()
                k = next((i for i in range(len(path) - 1, -1, -1) if path[i].tag == tag), -1)
                if k >= 0:
                    cut(k)
        elif tag in RAW:
            if not attributes.endswith("/") or tag != "svg":
                close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, pos)
                pos = close.end() if close else n
        elif tag == "br":
            text.append(" ")
        elif tag == "a":
            in_link = 1
        elif tag not in INLINE and tag not in VOID:
            flush()
            in_link = 0
            if (k := next((i for i in range(len(path) - 1, -1, -1) if path[i].tag == "p"), -1)) >= 0:
                cut(k)
            shut = CLOSES.get(tag, ())
            for i in range(len(path) - 1, -1, -1) if shut else ():
                if path[i].tag in shut:
                    cut(i)
                    break
                if path[i].tag in BARRIER:
                    break
            if len(path) >= DEEPEST:
                cut(DEEPEST - 1)
            made += 1
            path.append(_element(tag, attributes, any(x.main for x in path)))
            nodes.append(made)
            declared |= path[-1].main
        elif tag == "hr":
            flush()
    flush()
    return out, declared


def _smoothed(found: list[Leaf], value: dict, count: dict) -> dict:
    """Each path's mean value, smoothed over the paths of the leaves before and after it: half as much for each step of the tree between them."""
    total, weight = {p: value[p] / count[p] for p in count}, dict.fromkeys(count, 1.0)
    near: dict[tuple, float] = defaultdict(float)
    for a, b in zip(found, found[1:], strict=False):
        p, q = a.path, b.path
        if p != q:
            same = next((i for i, (x, y) in enumerate(zip(p, q, strict=False)) if x.name != y.name), min(len(p), len(q)))
            near[p, q] += 0.5 ** (len(p) + len(q) - 2 * same)
    out = dict(total)
    for (p, q), w in near.items():
        for x, y in ((p, q), (q, p)):
            out[x] += w / count[x] * total[y]
            weight[x] += w / count[x]
    return {p: out[p] / weight[p] for p in out}


def path_scores(found: list[Leaf], declared: bool) -> dict[tuple, float]:
    """The fused and weighted ratios of each path."""
    length, marks, links, count = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int)
    for leaf in found:
        length[leaf.path] += len(leaf.text)
        marks[leaf.path] += len(MARKS.findall(leaf.text))
        links[leaf.path] += leaf.links
        count[leaf.path] += 1
    long, marked = _smoothed(found, length, count), _smoothed(found, marks, count)
    out = {}
    for p in count:
        weight = prod(x.weight for x in p) * (1.0 - links[p] / length[p])
        if declared and not any(x.main for x in p):
            weight *= SIDE
        out[p] = sqrt(long[p] * (1 + marked[p])) * weight
    return out


def _subtree(found: list[Leaf], content: set, declared: bool) -> tuple[int, int] | None:
    """(depth, node) of the content subtree's root: down from the page's root, each time to the container that holds most of the selected text; in declared pages, the last declared element on the way."""
    mass: dict[int, int] = defaultdict(int)
    below: dict[int, dict[int, Element]] = defaultdict(dict)
    for leaf in found:
        if leaf.path in content:
            for above, node, element in zip((0, *leaf.nodes), leaf.nodes, leaf.path, strict=False):
                mass[node] += len(leaf.text)
                below[above][node] = element
    at, depth, root = 0, 0, None
    left = sum(len(x.text) for x in found if x.path in content)
    while below[at]:
        node = max(below[at], key=lambda x: (mass[x], -x))
        element = below[at][node]
        if mass[node] < MOST * left or element.tag not in CONTAINERS:
            break
        if element.main or not declared:
            root = depth, node
        at, depth, left = node, depth + 1, mass[node]
    return root


def select(found: list[Leaf], declared: bool, scores: dict[tuple, float]) -> list[Leaf]:
    """The leaves of the main text, given the paths' scores."""
    weight = {p: prod(x.weight for x in p) for p in scores}
    main = {p for p in scores if any(x.main for x in p)}
    top = max((weight[p] for p in (main or scores)), default=0.0)
    if top < LEAST and not main:  # all side matter: content only if one path of it is prose, and no article is declared
        most = max(scores, key=lambda p: scores[p], default=())
        prose = [x.text for x in found if x.path == most]
        if declared or sum(map(len, prose)) < PROSE * len(prose) or not any(map(MARKS.search, prose)):
            return []
    side = {p for p in scores if weight[p] < LEAST * top or not weight[p]}
    usable = {p: s for p, s in scores.items() if s > 0 and p not in side}
    best = max(usable.values(), default=0.0)
    content = {p for p, s in usable.items() if s >= LEAST * best}
    root = _subtree(found, content, declared)
    only_links = {p for p, s in scores.items() if s == 0}

    def completes(leaf: Leaf) -> bool:
        if root is None or len(leaf.nodes) <= root[0] or leaf.nodes[root[0]] != root[1]:
            return declared and leaf.path in main and leaf.path not in side
        return prod(x.weight for x in leaf.path[root[0] + 1 :]) >= LEAST and (declared or leaf.path not in only_links)

    return [leaf for leaf in found if leaf.path in content or completes(leaf)]


def main_text(page: str | None) -> str:
    found, declared = leaves(page or "")
    return "\n".join(leaf.text for leaf in select(found, declared, path_scores(found, declared)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "html"):
            texts = [main_text(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = bounded(pages).select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
