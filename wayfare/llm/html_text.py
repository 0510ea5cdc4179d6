"""Main text of web pages by tag-path ratios.

A page is a sequence of text blocks, each with its root-to-leaf tag path; the
paths form a prefix tree.  Per path, text length and punctuation are aggregated
over its blocks: the ratio of a path is characters per block times one plus
punctuation marks per block, less the share of linked text.  Ratios are
smoothed down the prefix tree: every prefix that two paths share lets each
count for the other, the longer the more.  A smoothed ratio is fused with the
best of the containers that the path lies in, at any depth (so lists, tables
and quotes of a text stay with it), and paths at or above a share of the page's
best are content.

Menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments, known by element or by class name (``hints``), have
no ratio.  An article or main element is a prior: the ratios inside count
``prior`` times.  One page is one row: a scan and no shuffle, and time is
linear in the page.

Edge cases: null, empty or tag-free html (the last is one block of text);
unclosed comments, scripts and tags run to the end of the page or of their
parent; a page without content has the empty string; equal ratios are content
together; repeated rows are extracted again; an empty table gives an empty
result; pages are read whole, however long or deep; extra columns pass through,
also those with the names of our own.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, tidy

_ATTRS = r"""(?:[^>"']|"[^"]*"|'[^']*'|["'])*+"""
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|math|object|noembed|xmp)\b{_ATTRS}(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS})(?:>|\Z)",
    re.S | re.I,
)
CLASSES = re.compile(r"""\b(?P<name>class|id|role)\s*=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\s>]+))""", re.I)
PARTS = re.compile(r"[^a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
BREAKS = frozenset(("br", "hr"))
#: Start tags that end an open element of the listed kinds, as the HTML standard has it.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
SCOPES = frozenset("html body article main section div ul ol dl table td th nav header footer aside form blockquote figure".split())
BOILERPLATE = frozenset("head nav header footer aside form button select menu dialog fieldset".split())
ROOTS = frozenset(("html", "body", "article", "main"))
#: Words of class, id and role that mark boilerplate.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup sidebar side aside complementary "
    "menu nav navbar navigation breadcrumb breadcrumbs masthead header footer contentinfo copyright legal disclaimer comment comments "
    "respond replies disqus related recommended share sharing social widget toolbar login search searchbox pagination pager skip dialog".split()
)
BESIDE = frozenset("has with without no is js".split())
#: Classes of articles that are not the page's own.
NOT_MAIN = frozenset("comment comments reply teaser related ad advert promo sponsored".split())
STRONG = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PUNCTUATION = re.compile(r"[.,;:!?。，！？…]")


def _hinted(tag: str, value: str) -> bool:
    """Whether a class, id or role marks boilerplate: one of its names has a hint word, unless it only tells what is beside (``with-sidebar``)."""
    names = value.split()
    if tag in ROOTS:
        return tag == "article" and not NOT_MAIN.isdisjoint(names)
    return any(parts[0] not in BESIDE and not HINTS.isdisjoint(parts) for parts in map(PARTS.split, names))


#: How often ratios inside an article or main element count.
PRIOR = 16.0
#: A path counts for another with this factor for each element that the other has below their common prefix.
DECAY = 0.02


class Page:
    """Prefix tree of the tag paths of a page, and its blocks: (text, node).

    Node 0 is the root; a node has its parent, its tag and the outermost
    article or main element that it lies in (-1: none).
    """

    def __init__(self, hints: bool = True):
        self.hints = hints
        self.parent, self.tag, self.strong = [-1], [""], [-1]
        self.children: dict[tuple[int, str], int] = {}
        self.chars, self.marks, self.count, self.linked = [0], [0], [0], [0]
        self.blocks: list[tuple[str, int]] = []
        # open elements: tag, node, whether inside boilerplate, number of open links
        self.stack: list[tuple[str, int, bool, int]] = [("", 0, False, 0)]
        self.open: dict[str, int] = {}
        self.text: list[str] = []
        self.in_links = 0

    def child(self, node: int, tag: str, label: str) -> int:
        found = self.children.get((node, label))
        if found is None:
            found = self.children[node, label] = len(self.parent)
            self.parent.append(node)
            self.tag.append(tag)
            strong = self.strong[node]
            self.strong.append(found if strong < 0 and tag in STRONG else strong)
            for column in (self.chars, self.marks, self.count, self.linked):
                column.append(0)
        return found

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                node = self.stack[-1][1]
                self.blocks.append((text, node))
                self.chars[node] += len(text)
                self.marks[node] += len(PUNCTUATION.findall(text))
                self.count[node] += 1
                self.linked[node] += min(self.in_links, len(text))
            self.text, self.in_links = [], 0

    def words(self, piece: str) -> None:
        _, _, out, links = self.stack[-1]
        if out:
            return
        if "&" in piece:
            piece = entities.unescape(piece)
        self.text.append(piece)
        if links:
            self.in_links += len(piece.strip())

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            self.open[self.stack.pop()[0]] -= 1

    def close(self, kinds: tuple[str, ...]) -> None:
        """End the innermost open element of these kinds, if no scope lies between."""
        if not any(self.open.get(k) for k in kinds):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i][0]
            if tag in kinds:
                self.pop_to(i)
                return
            if tag in SCOPES:
                return

    def start(self, tag: str, attrs: str) -> None:
        label, out = tag, self.hints and tag in BOILERPLATE
        if "=" in attrs:
            for m in CLASSES.finditer(attrs):
                value = (m["a"] or m["b"] or m["c"] or "").lower()
                if m["name"].lower() == "class" and value.split():
                    label = f"{tag}.{value.split()[0]}"
                if self.hints and not out:
                    out = _hinted(tag, value)
        if tag not in INLINE:
            if tag not in VOID:
                self.close(("p",))
            if tag in CLOSES:
                self.close(CLOSES[tag])
        if tag not in VOID and not attrs.rstrip().endswith("/"):
            _, node, inside, links = self.stack[-1]
            if tag not in INLINE:
                node = self.child(node, tag, label)
            self.stack.append((tag, node, inside or out, links + (tag == "a")))
            self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if self.open.get(tag):
            i = len(self.stack) - 1
            while self.stack[i][0] != tag:
                i -= 1
            self.pop_to(i)


def parse(html: str, hints: bool = True) -> Page:
    """Text blocks in page order (references decoded, white space collapsed, boilerplate left out) and their paths."""
    page, at = Page(hints), 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            page.words(html[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            page.flush()
        if m["end"]:
            page.end(tag)
        elif tag not in BREAKS:
            page.start(tag, m["attrs"])
    if at < len(html):
        page.words(html[at:])
    page.flush()
    return page


def ratios(page: Page) -> list[float]:
    """Ratio of every path with text: characters and punctuation per block, less the share of linked text."""
    out = [0.0] * len(page.parent)
    for p, n in enumerate(page.count):
        if n:
            out[p] = page.chars[p] / n * (1 + page.marks[p] / n) * (1 - 0.9 * page.linked[p] / page.chars[p])
    return out


def smoothed(page: Page, ratio: list[float], decay: float = DECAY) -> list[float]:
    """Ratios averaged over all paths of the page that have text, by how long a prefix they share.

    A path q counts for p with the sum of ``decay ** (len(p) - j)`` over the
    lengths j of their common prefixes.  Sums go up the prefix tree
    once and, decaying, down again: linear, whatever the number of paths.
    """
    n = len(ratio)
    weight = [1.0 if c else 0.0 for c in page.count]
    total = [r * w for r, w in zip(ratio, weight, strict=True)]
    for p in range(n - 1, 0, -1):  # children come after their parents
        total[page.parent[p]] += total[p]
        weight[page.parent[p]] += weight[p]
    for p in range(1, n):
        total[p] += decay * total[page.parent[p]]
        weight[p] += decay * weight[page.parent[p]]
    return [t / w if w else 0.0 for t, w in zip(total, weight, strict=True)]


def path_scores(page: Page, container_share: float = 0.7, prior: float = PRIOR, ratio: list[float] | None = None) -> list[float]:
    """Fused ratio of every path that has text (others: 0)."""
    smooth = smoothed(page, ratios(page) if ratio is None else ratio)
    n, texts = len(smooth), [p for p, c in enumerate(page.count) if c]
    home = [page.strong[p] if page.strong[p] >= 0 else max(page.parent[p], 0) for p in range(n)]
    container, bears = [0.0] * n, [0.0] * n
    for p in texts:
        container[home[p]] = max(container[home[p]], smooth[p])
        # what an element bears is its own text and that of blocks directly in it which are no containers themselves
        bears[p] = max(bears[p], smooth[p])
        if p and page.tag[p] not in SCOPES:
            bears[page.parent[p]] = max(bears[page.parent[p]], smooth[p])
    above = [0.0] * n
    for p in range(1, n):
        above[p] = max(above[page.parent[p]], bears[page.parent[p]])
    out = [0.0] * n
    for p in texts:
        # lists of links get no support from the text around them; a heading may be a link
        own = 1.0 if page.tag[p] in HEADINGS else 1 - 0.9 * page.linked[p] / page.chars[p]
        support = own * max(container[home[p]], above[p])
        out[p] = (prior if page.strong[p] >= 0 else 1.0) * max(smooth[p], container_share * support)
    return out


def main_blocks(html: str | None, least_share: float = 0.6, hints: bool = True, prior: float = PRIOR) -> list[str]:
    """Texts of the content blocks of a page, in page order; without ``hints`` and with ``prior`` 1 the ratios alone decide."""
    page = parse(html or "", hints)
    scores = path_scores(page, prior=prior)
    least = least_share * max(scores)
    return [text for text, p in page.blocks if scores[p] >= least]


def extract(pages: DataFrame, html_col: str = "html", least_share: float = 0.6) -> DataFrame:
    """``pages`` without the html column and with ``text`` (main text; blocks joined by one blank) and ``n_blocks``.

    Where ``pages`` has a column of such a name, ours gets underscores behind it.
    """
    keep = [c for c in pages.columns if c != html_col]
    others = pages.drop(html_col)
    names = [free_name(others, "text"), free_name(others, "n_blocks")]
    narrow = pages.select(*[pages[f"`{c}`"] for c in keep], F.col(html_col).cast("string").alias(html_col))
    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField(names[0], T.StringType()), T.StructField(names[1], T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts, counts = [], []
                for value in part.column(part.num_columns - 1):
                    found = main_blocks(value.as_py(), least_share)
                    texts.append(" ".join(found).encode("utf-8", "replace").decode("utf-8"))
                    counts.append(len(found))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array(counts, pa.int32())], names=schema.names)

    return narrow.mapInArrow(tidy(run), schema)
