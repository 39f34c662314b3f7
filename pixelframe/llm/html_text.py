"""HTML extraction: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags. Each block is described by
its word count and link density, those of its neighbours, and what kind of
container it stands in; a tree trained on a small labelled table says which
blocks are main text.

Edge cases: a null or empty html has an empty text; comments, scripts, styles
and a tag that the end of the page cuts off give no text, unclosed tags are
closed by the page's end, but of unseen elements only script, style and title
reach that far; repeated rows are separate pages.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pixelframe.llm.common import load
from pixelframe.llm.registry import query

#: Elements whose content is never text of the page; without an end tag, only the sealed ones run to its end.
_UNSEEN = frozenset(
    "script style title noscript template svg annotation annotation-xml iframe object canvas audio video select"
    " textarea button".split()
)
_SEALED = frozenset("script style title".split())
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in _UNSEEN}
_TOKEN = re.compile(
    # quotes enclose a value only right after its equals sign
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold other blocks, and so pass on what they are.
_CONTAINERS = _BLOCKS - frozenset("body head hr html p h1 h2 h3 h4 h5 h6 option".split())
_AROUND = frozenset("nav footer aside form menu dialog fieldset".split())
#: Of these, those that never hold a page as a whole.
_ALWAYS_AROUND = _AROUND - {"form", "fieldset"}
#: A block of so many words, less than half of them links, is text.
TEXT_WORDS = 15
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ARTICLE = frozenset("article main".split())
#: Words of class, id and role that mark what surrounds an article, and the article itself.
_AROUND_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disclaimer disqus footer masthead menu modal nav navbar navigation newsletter notice overlay pagination"
    " paywall popup promo promoted promotion recommended related replies respond share sharing sidebar signup"
    " site-header skip social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
#: Of these, those that as a part of a longer name say as much as alone.
_FIRM_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disclaimer disqus footer masthead menu nav navbar navigation newsletter pagination paywall popup promo promoted"
    " replies respond share sharing signup sponsor sponsored subscribe toolbar topbar".split()
)
#: What begins a name that tells a state of the page, not what an element is.
_STATES = frozenset("has is no not with without".split())
_ARTICLE_WORDS = frozenset("article articlebody entry-content post-content article-body story story-body".split())
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HREF = re.compile(r"""(?<![^\s"'/])href\s*=""", re.I)
_NEXT_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)


class Block(NamedTuple):
    text: str
    words: int
    linked: float
    around: bool
    article: bool
    heading: bool
    hinted: bool


class Mark(NamedTuple):
    """What an open element is: surrounding, an article, or named a little like something surrounding."""

    tag: str
    around: bool
    article: bool
    hinted: bool = False


def _mark(tag: str, attributes: str, in_article: bool) -> Mark:
    if tag in _ARTICLE:
        return Mark(tag, False, True)
    if tag in _AROUND or (tag == "header" and not in_article):
        return Mark(tag, True, False)
    names = {w for m in _ATTRIBUTE.finditer(attributes) for w in re.split(r"\s+", (m[1] or m[2] or m[3] or "").lower())}
    around, hinted = bool(names & _AROUND_WORDS), False
    for name in names:
        pieces = [p for p in re.split(r"[^a-z]+", name) if p]
        if len(pieces) > 1 and pieces[0] not in _STATES:
            around |= not _FIRM_WORDS.isdisjoint(pieces)
            hinted |= not _AROUND_WORDS.isdisjoint(pieces)
    article = any(n in _ARTICLE_WORDS or "article" in re.split(r"[^a-z]+", n) or "story" in re.split(r"[^a-z]+", n) for n in names)
    return Mark(tag, around, article, hinted)


def _outside(stack: list[Mark]) -> int | None:
    """How many marks stand around the innermost article; None where it holds marks or has no say.

    Marks that never hold a page as a whole, such as that of an aside, stay as they are.
    """
    own = max((k for k, s in enumerate(stack) if s.article and not s.around), default=None)
    if own is None or any(s.around for s in stack[own:]) or any(s.around and s.tag in _ALWAYS_AROUND for s in stack[:own]):
        return None
    return sum(s.around for s in stack[:own])


def _released(blocks: list[Block], outside: list[int | None]) -> list[Block]:
    """``blocks`` without the marks around the articles that stand in the fewest.

    A wrapper of the whole page says nothing about its article; articles in more
    marks than others, such as comments or teasers, keep them.
    """
    counted = [(b, n) for b, n in zip(blocks, outside, strict=True) if n is not None]
    texts = [n for b, n in counted if b.words >= TEXT_WORDS and b.linked < 0.5]
    least = min(texts or [n for _, n in counted], default=0)
    return [
        b._replace(around=False) if n is not None and n <= least else b for b, n in zip(blocks, outside, strict=True)
    ]


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    found: list[Block] = []
    outside: list[int | None] = []
    stack: list[Mark] = []
    text: list[str] = []
    links: list[str] = []
    link, loose, heading, at = False, False, False, 0
    endless: set[str] = set()

    def add(raw: str) -> None:
        decoded = references.unescape(raw)
        text.append(decoded)
        if link:
            links.append(decoded)

    def end_block() -> None:
        words = "".join(text).split()
        if words:
            linked = len("".join(links).split()) / len(words)
            around, article, hinted = (any(s[k] for s in stack) for k in (1, 2, 3))
            found.append(Block(" ".join(words), len(words), linked, around, article, heading, hinted))
            outside.append(_outside(stack))
        text.clear()
        links.clear()

    while token := _TOKEN.search(page, at):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        closing, tag, attributes = token[1] or token[4], token[2] or token[5], token[3] or token[6] or ""
        if not tag:
            continue
        tag = tag.lower()
        if tag in _UNSEEN and not closing and (not attributes or attributes[0] in "/ \t\n\r\f"):
            if tag in _SEALED or not (attributes.endswith("/") or tag in endless):
                end = _ENDS[tag].search(page, at)
                if end or tag in _SEALED:
                    at = end.end() if end else len(page)
                else:
                    endless.add(tag)
            continue
        if tag == "a":
            link = not closing and bool(_HREF.search(attributes))
            after = _NEXT_LINK.search(page, at) if link else None
            loose = after is None or not after[1]  # never closed: the end of its block closes it
        elif tag in ("br", "img", "input"):
            text.append(" ")
        if tag not in _BLOCKS:
            continue
        end_block()
        link = link and not loose
        heading = tag in _HEADINGS and not closing
        if tag not in _CONTAINERS:
            continue
        link = False
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
        elif not attributes.endswith("/"):
            stack.append(_mark(tag, attributes, any(s.article for s in stack)))
    if at < len(page):
        add(page[at:])
    end_block()
    return _released(found, outside)


def features(blocks: list[Block]) -> np.ndarray:
    """A row per block, columns as in ``FEATURES``."""
    n = len(blocks)
    out = np.zeros((n + 2, len(FEATURES)))
    out[1:-1, 0] = [b.words for b in blocks]
    out[1:-1, 1] = [b.linked for b in blocks]
    out[1:-1, 2], out[1:-1, 3] = out[:-2, 0], out[:-2, 1]
    out[1:-1, 4], out[1:-1, 5] = out[2:, 0], out[2:, 1]
    out[1:-1, 6] = [b.around for b in blocks]
    out[1:-1, 7] = [b.article for b in blocks]
    out[1:-1, 8] = [b.heading for b in blocks]
    out[1:-1, 9] = any(b.article for b in blocks)
    out[1:-1, 10] = [b.hinted for b in blocks]
    return out[1:-1]


FEATURES = (
    "words", "link density", "words before", "link density before", "words after", "link density after",
    "surrounds", "in article", "heading", "page has article", "named like surroundings",
)
#: Labelled blocks: the features above but the last, which is 0, then 1 for main text.
LABELLED = (
    # paragraphs, short and long, lists and titles of a marked article
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 1, 0, 1, 1), (3, 0.0, 90, 0.0, 45, 0.0, 0, 1, 0, 1, 1),
    (1, 0.0, 30, 0.0, 0, 0.0, 0, 1, 0, 1, 1), (6, 0.0, 12, 0.2, 40, 0.0, 0, 1, 1, 1, 1),
    (4, 0.0, 0, 0.0, 5, 0.0, 0, 1, 1, 1, 1), (25, 0.2, 30, 0.0, 8, 1.0, 0, 1, 0, 1, 1),
    (12, 0.4, 30, 0.1, 2, 1.0, 0, 1, 0, 1, 1), (2, 0.0, 1, 1.0, 3, 1.0, 0, 1, 0, 1, 1),
    (400, 0.02, 1, 1.0, 5, 0.0, 0, 1, 0, 1, 1), (9, 0.0, 6, 0.0, 0, 0.0, 0, 1, 0, 1, 1),
    # runs of links inside an article
    (2, 1.0, 40, 0.0, 2, 1.0, 0, 1, 0, 1, 0), (3, 1.0, 2, 1.0, 3, 1.0, 0, 1, 0, 1, 0),
    (6, 0.9, 5, 1.0, 0, 0.0, 0, 1, 0, 1, 0), (8, 1.0, 60, 0.0, 7, 1.0, 0, 1, 0, 1, 0),
    # what a container marks as surrounding, in and out of an article
    (60, 0.0, 70, 0.0, 50, 0.0, 1, 1, 0, 1, 0), (8, 0.0, 3, 1.0, 6, 0.0, 1, 0, 0, 1, 0),
    (40, 0.0, 3, 1.0, 6, 0.0, 1, 0, 0, 1, 0), (2, 1.0, 2, 1.0, 2, 1.0, 1, 0, 0, 1, 0),
    (90, 0.0, 60, 0.0, 80, 0.0, 1, 0, 0, 0, 0), (12, 0.0, 70, 0.0, 0, 0.0, 1, 0, 0, 0, 0),
    (4, 0.0, 0, 0.0, 60, 0.0, 1, 0, 1, 0, 0), (30, 0.1, 1, 1.0, 1, 1.0, 1, 0, 0, 0, 0),
    (5, 0.0, 8, 0.0, 9, 0.0, 1, 1, 1, 1, 0), (120, 0.0, 5, 0.0, 5, 0.0, 1, 1, 0, 1, 0),
    # unmarked text beside a marked article
    (7, 0.0, 2, 1.0, 6, 0.0, 0, 0, 0, 1, 0), (50, 0.0, 60, 0.0, 3, 1.0, 0, 0, 0, 1, 0),
    (5, 0.0, 80, 0.0, 2, 1.0, 0, 0, 1, 1, 0), (90, 0.1, 3, 0.0, 2, 0.0, 0, 0, 0, 1, 0),
    (7, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0, 1, 0), (4, 0.0, 0, 0.0, 30, 0.0, 0, 0, 1, 1, 0),
    (20, 0.1, 60, 0.0, 80, 0.0, 0, 0, 0, 1, 0), (12, 0.0, 5, 0.0, 200, 0.0, 0, 0, 0, 1, 0),
    (300, 0.0, 9, 0.0, 45, 0.0, 0, 0, 0, 1, 0), (35, 0.0, 40, 0.0, 12, 0.0, 0, 0, 0, 1, 0),
    (16, 0.0, 25, 0.0, 5, 0.0, 0, 0, 0, 1, 0), (28, 0.0, 1, 1.0, 90, 0.0, 0, 0, 0, 1, 0),
    # pages that mark no article: long text, what lies between, titles over it
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 0, 0, 0, 1), (30, 0.1, 2, 1.0, 45, 0.0, 0, 0, 0, 0, 1),
    (16, 0.0, 50, 0.0, 2, 1.0, 0, 0, 0, 0, 1), (22, 0.3, 24, 0.1, 30, 0.0, 0, 0, 0, 0, 1),
    (4, 0.0, 60, 0.0, 55, 0.0, 0, 0, 0, 0, 1), (9, 0.0, 25, 0.0, 30, 0.0, 0, 0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 40, 0.0, 0, 0, 1, 0, 1), (5, 0.0, 30, 0.0, 60, 0.0, 0, 0, 1, 0, 1),
    (18, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0, 1), (14, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1),
    (60, 0.0, 40, 0.0, 2, 1.0, 0, 0, 0, 0, 1), (150, 0.0, 3, 1.0, 4, 0.0, 0, 0, 0, 0, 1),
    (45, 0.1, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (35, 0.0, 2, 1.0, 5, 1.0, 0, 0, 0, 0, 1),
    # and their short, isolated or linked blocks
    (4, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (5, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0, 0, 0),
    (3, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (7, 0.0, 1, 1.0, 5, 0.0, 0, 0, 0, 0, 0),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (30, 0.9, 2, 1.0, 60, 0.0, 0, 0, 0, 0, 0),
    (18, 0.7, 40, 0.0, 40, 0.0, 0, 0, 0, 0, 0), (5, 1.0, 50, 0.0, 45, 0.0, 0, 0, 0, 0, 0),
    (3, 0.0, 4, 0.0, 2, 1.0, 0, 0, 1, 0, 0), (8, 0.0, 50, 0.0, 2, 1.0, 0, 0, 0, 0, 0),
)
#: The same of blocks in an element whose name only resembles something surrounding.
RESEMBLING = (
    # within an article it says little
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 1, 0, 1, 1), (2, 0.0, 90, 0.0, 45, 0.0, 0, 1, 1, 1, 1),
    (5, 0.0, 3, 0.0, 30, 0.0, 0, 1, 0, 1, 1), (25, 0.2, 30, 0.0, 8, 1.0, 0, 1, 0, 1, 1),
    (3, 1.0, 2, 1.0, 3, 1.0, 0, 1, 0, 1, 0), (8, 1.0, 60, 0.0, 7, 1.0, 0, 1, 0, 1, 0),
    # beside one it is what it is called
    (40, 0.0, 3, 1.0, 6, 0.0, 0, 0, 0, 1, 0), (5, 0.0, 80, 0.0, 2, 1.0, 0, 0, 0, 1, 0),
    # on a page that marks none, long text is text
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 0, 0, 0, 1), (30, 0.1, 2, 1.0, 45, 0.0, 0, 0, 0, 0, 1),
    (45, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (18, 0.0, 50, 0.0, 40, 0.0, 0, 0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 4, 0.0, 0, 0, 0, 0, 0), (3, 0.0, 4, 0.0, 2, 1.0, 0, 0, 1, 0, 0),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (30, 0.9, 2, 1.0, 60, 0.0, 0, 0, 0, 0, 0),
)


class Node(NamedTuple):
    """A test (column <= cut) with its two sides, or a leaf, whose column is None."""

    column: int | None
    cut: float
    low: Node | None
    high: Node | None
    main: bool


def grow(x: np.ndarray, y: np.ndarray) -> Node:
    """A tree by Gini impurity that fits the table; ties go to the earlier column."""
    if y.all() or not y.any():
        return Node(None, 0, None, None, bool(y.all()))
    best = None
    for column in range(x.shape[1]):
        values = np.unique(x[:, column])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, column] <= cut
            impurity = sum(s.sum() * (p := y[s].mean()) * (1 - p) for s in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, column, cut, low)
    if best is None:
        return Node(None, 0, None, None, bool(y.mean() > 0.5))
    _, column, cut, low = best
    return Node(column, float(cut), grow(x[low], y[low]), grow(x[~low], y[~low]), False)


def trained_tree() -> Node:
    table = np.array(LABELLED + RESEMBLING, float)
    resembling = np.arange(len(table)) >= len(LABELLED)
    return grow(np.column_stack([table[:, :-1], resembling]), table[:, -1] == 1)


def is_main(node: Node, x: np.ndarray) -> np.ndarray:
    if node.column is None:
        return np.full(len(x), node.main)
    low = x[:, node.column] <= node.cut
    out = np.empty(len(x), bool)
    out[low], out[~low] = is_main(node.low, x[low]), is_main(node.high, x[~low])
    return out


def main_text(page: str, tree: Node) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    keep = is_main(tree, features(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tree = trained_tree()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, tree) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    columns = pages.select("page_id", "url", "html")
    return columns.mapInArrow(rows, "page_id long, url string, text string, n_chars long")


@query("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(load(spark, sf_dir, "pages"))
