"""Main text of HTML pages from flat text blocks.

A page is cut into a flat list of text blocks at block-level tags. Every block gets its number of words, its link
density (share of its words inside links), the same of the block before and after, how far the nearest running text before and
after it is, and what encloses it (article, boilerplate element, boilerplate name, heading, list; of article, element and name the
nearest counts). A decision tree, trained by :func:`train_tree` on the small labelled table
:data:`LABELLED`, tells main text from the rest; the blocks it keeps are joined in page order.

Reader comments, adverts, notices, newsletter, sharing and related boxes are told by any word of a class, id or role and go whatever
their length, comments that are article elements too. A header inside an article holds its headline and stays. Other names
(sidebar, legal) do not outweigh long text without links. An article's own class does not count.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one space. Text
of scripts, styles, comments, titles and the like is never a block; that of formulas (but for their source in an annotation) and
the content of objects is. Null and empty pages give an empty text; broken or
cut-off markup is read as far as it goes (an unclosed script or comment lasts to the end of the page). Rows that repeat a
page_id and rows without one get one result row each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.tokens import slices
from caseload.llm.worker import map_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|noscript|template|iframe|svg|annotation|select|canvas)\b[^>]*+(?:/>|>.*?(?:</\1\s*+>|\Z))"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)

_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                    "strike strong sub sup time tt u var wbr "
                    "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover "
                    "munderover".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset("article main".split())
_APART = frozenset("nav header footer aside form menu dialog button fieldset".split())
#: Words that, alone or together, are a class, id or role of something other than the article.
_NAMES = frozenset("ad ads adv advert advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies "
                   "consent gdpr privacy notice notices alert warning popup modal overlay newsletter subscribe subscription "
                   "signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended "
                   "recommendations more share sharing social footer header masthead copyright legal comment comments reply "
                   "replies discussion disqus respond form search pagination pager toolbar contentinfo complementary dialog "
                   "skip hidden".split())
#: Words of a class, id or role that name something apart wherever they stand in it, and those that make it the name of a state.
_ALWAYS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsbygoogle adbox adslot sponsor sponsored promo promos "
                    "promotion cookie cookies consent gdpr newsletter subscribe signup comment comments commentlist reply replies disqus respond "
                    "related recommended recommendations share sharing social".split())
_REMARKS = frozenset("comment comments commentlist reply replies disqus respond".split())
_STATES = frozenset("has have no not non with without is are open opened closed enabled disabled off on allowed free count single hide".split())
#: Words of :data:`_NAMES` that also name a paragraph or heading of an article.
_SOFT = frozenset("alert comment legal more notice notices privacy recommended reply search warning".split())
#: Words that may stand before the last one of a name, as in site-footer.
_WHERE = frozenset("site page main global top bottom left right primary secondary post article entry".split())
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block(NamedTuple):
    text: str
    words: int
    link_words: int
    apart: int  # inside an element or box (2) or name (1) that is not the article's, with no article or main element nearer
    article: int  # inside an article or main element
    heading: int
    listed: int


FEATURES = ("words", "link density", "words before", "link density before", "words after", "link density after", "apart",
            "article", "heading", "listed", "to text before", "to text after")
#: Words and link density of a block of running text, and the blocks beyond which there is none near.
TEXT_WORDS, TEXT_LINKS, FAR = 15, 0.35, 6


def _is_name(token: str, soft: bool) -> bool:
    """Whether a class, id or role as a whole names something apart: no-sidebar and has-comments do not."""
    words = [w for w in _SPLIT.split(token.lower()) if w]
    while len(words) > 1 and words[0] in _WHERE:
        words = words[1:]
    return bool(words) and _NAMES.issuperset(words) and not (soft and _SOFT.issuperset(words))


def _named(attributes: str) -> Iterator[tuple[str, set[str]]]:
    """The classes, ids and roles, each with its words (``adSlot`` has two)."""
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        for token in (a or b or c).split():
            yield token, {w for w in _SPLIT.split(_CAMEL.sub("-", token).lower()) if w}


def _apart(tag: str, attributes: str, inside: bool = False) -> int:
    """3 for reader comments, 2 for another element or box that is apart or hidden, 1 for one that is only named so, else 0. ``inside``: within
    an article or main element, whose header is its own."""
    if tag in _APART and not (tag == "header" and inside):
        return 2
    if not attributes or attributes.isspace():
        return 0
    if _HIDDEN.search(attributes):
        return 2
    soft = tag == "p" or tag in _HEADINGS
    most = 0
    for token, words in _named(attributes):
        if words & _ALWAYS and not words & _STATES and not (soft and words <= _SOFT):
            most = max(most, 3 if words & _REMARKS else 2)
        elif _is_name(token, soft):
            most = max(most, 1)
    return most if tag not in _MAIN or most == 3 else 0


def _nearest(stack: list[tuple[str, int, bool]]) -> int:
    """What the open elements inside the nearest article or main element say of being apart."""
    most = 0
    for _, apart, main in reversed(stack):
        most = max(most, apart)
        if main:
            break
    return min(most, 2)


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []  # text of the open block, and whether it stands in a link
    stack: list[tuple[str, int, bool]] = []  # open elements: tag, apart, main
    links = heading = 0
    page = page or ""

    def flush() -> None:
        nonlocal parts
        if parts:
            words = "".join(t for t, _ in parts).split()
            if words:
                linked = sum(len(t.split()) for t, inside in parts if inside)
                out.append(Block(" ".join(words), len(words), min(linked, len(words)), _nearest(stack),
                                 int(any(m for _, _, m in stack)), int(heading > 0), int(any(t == "li" for t, _, _ in stack))))
            parts = []

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append((html.unescape(page[at:token.start()]), links > 0))
        at = token.end()
        tag = (token[3] or token[6] or "").lower()
        if not tag:
            continue
        closing, attributes = token[2] or token[5], token[4] or token[7] or ""
        if tag == "a":
            links = max(0, links - 1) if closing else 1
        if tag in _INLINE:
            if tag in ("span", "label") and not closing and (apart := _apart(tag, attributes)):
                flush()
                stack.append((tag, apart, False))
            elif closing and any(t == tag for t, _, _ in stack):
                flush()
                while stack.pop()[0] != tag:
                    pass
            continue
        flush()
        if tag in _HEADINGS:
            heading = 0 if closing else 1
        if closing:
            links = 0
            if any(t == tag for t, _, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in _VOID and not attributes.endswith("/"):
            if stack and (stack[-1][0] == "p" or tag == "li" and stack[-1][0] == "li"):
                stack.pop()  # these end where a block begins
            if tag not in ("html", "body"):
                apart = _apart(tag, attributes, any(m for _, _, m in stack))
                # An article among the reader comments is one of them.
                stack.append((tag, apart, tag in _MAIN and apart < 3 and all(a < 3 for _, a, _ in stack)))
    if at < len(page):
        parts.append((html.unescape(page[at:]), links > 0))
    flush()
    return out


def _distances(text: np.ndarray) -> np.ndarray:
    """Blocks from each one back to the last one of running text before it, :data:`FAR` at most."""
    at = np.arange(len(text))
    last = np.maximum.accumulate(np.where(text, at, -FAR))
    return np.minimum(at - np.r_[-FAR, last[:-1]][:len(text)], FAR)


def features(found: list[Block]) -> np.ndarray:
    """One row of :data:`FEATURES` for each block."""
    n = len(found)
    own = np.array([(b.words, b.link_words / b.words) for b in found], float).reshape(n, 2)
    edge = np.zeros((1, 2))
    before, after = np.r_[edge, own[:-1]][:n], np.r_[own[1:], edge][:n]
    context = np.array([(b.apart, b.article, b.heading, b.listed) for b in found], float).reshape(n, 4)
    text = (own[:, 0] >= TEXT_WORDS) & (own[:, 1] < TEXT_LINKS) & (context[:, 0] == 0)
    return np.hstack([own, before, after, context, np.c_[_distances(text), _distances(text[::-1])[::-1]]])


# The labelled table: pages as runs of blocks (keep, words, words in links, apart, article, heading, listed).
_NAV = [(0, 1, 1, 2, 0, 0, 1), (0, 1, 1, 2, 0, 0, 1), (0, 2, 2, 2, 0, 0, 1)]
_PLAIN_NAV = [(0, 1, 1, 0, 0, 0, 1), (0, 2, 2, 0, 0, 0, 1), (0, 1, 1, 0, 0, 0, 1)]
_AD = [(0, 4, 0, 1, 0, 0, 0)]
_LONG_AD = [(0, 28, 0, 1, 0, 0, 0)]
_FOOT = [(0, 16, 1, 2, 0, 0, 0)]
_ASIDE = [(0, 2, 0, 2, 0, 1, 0), (0, 70, 1, 2, 0, 0, 0), (0, 130, 0, 2, 0, 0, 0)]
_PLAIN_FOOT = [(0, 7, 3, 0, 0, 0, 0), (0, 6, 0, 0, 0, 0, 0)]
_ARTICLE = [(1, 9, 0, 0, 1, 1, 0), (1, 80, 0, 0, 1, 0, 0), (1, 4, 0, 0, 1, 0, 0), (1, 35, 2, 0, 1, 0, 0), (1, 1, 0, 0, 1, 0, 0),
            (1, 120, 0, 0, 1, 0, 0), (1, 6, 0, 0, 1, 0, 1), (1, 14, 0, 0, 1, 0, 1), (1, 3, 0, 0, 1, 1, 0), (1, 22, 1, 0, 1, 0, 0)]
_SHORT_ARTICLE = [(1, 3, 0, 0, 1, 1, 0), (1, 2, 0, 0, 1, 0, 0), (1, 1, 0, 0, 1, 0, 0)]
_LINKED_ARTICLE = [(1, 6, 0, 0, 1, 1, 0), (1, 4, 1, 0, 1, 0, 0), (1, 12, 7, 0, 1, 0, 0), (1, 3, 3, 0, 1, 0, 0), (1, 25, 9, 0, 1, 0, 0),
                   (1, 5, 4, 0, 1, 0, 1), (1, 9, 5, 0, 1, 0, 1), (1, 2, 2, 0, 1, 0, 1), (1, 7, 7, 0, 1, 0, 1), (1, 14, 14, 0, 1, 0, 0)]
_IN_ARTICLE = [(0, 5, 5, 1, 1, 0, 0), (0, 9, 0, 1, 1, 0, 0), (0, 40, 0, 1, 1, 0, 0), (0, 3, 3, 1, 1, 0, 1)]
_COMMENTS = [(0, 2, 0, 2, 0, 1, 0), (0, 30, 0, 2, 0, 0, 0), (0, 85, 1, 2, 0, 0, 0), (0, 4, 0, 2, 0, 0, 1), (0, 140, 0, 2, 0, 0, 0)]
_BOX = [(0, 3, 0, 2, 1, 1, 0), (0, 90, 0, 2, 1, 0, 0), (0, 35, 2, 2, 1, 0, 0), (0, 7, 7, 2, 1, 0, 1)]
_BODY = [(1, 8, 0, 0, 0, 1, 0), (1, 60, 0, 0, 0, 0, 0), (1, 45, 2, 0, 0, 0, 0), (1, 18, 0, 0, 0, 0, 0), (1, 90, 1, 0, 0, 0, 0),
         (1, 5, 0, 0, 0, 1, 0), (1, 33, 0, 0, 0, 0, 0), (1, 15, 0, 0, 0, 0, 1), (1, 70, 0, 0, 0, 0, 0)]
# Without an article element: headline, byline, short paragraphs and lists near running text.
_SPARSE_BODY = [(1, 7, 0, 0, 0, 1, 0), (1, 3, 0, 0, 0, 0, 0), (1, 4, 1, 0, 0, 0, 0), (1, 55, 0, 0, 0, 0, 0), (1, 2, 0, 0, 0, 0, 0), (1, 48, 1, 0, 0, 0, 0),
                (1, 3, 0, 0, 0, 1, 0), (1, 4, 0, 0, 0, 0, 1), (1, 2, 0, 0, 0, 0, 1), (1, 9, 2, 0, 0, 0, 1), (1, 25, 0, 0, 0, 0, 0), (1, 1, 0, 0, 0, 0, 0),
                (1, 64, 3, 0, 0, 0, 0)]
_RELATED = [(0, 3, 0, 0, 0, 1, 0), (0, 7, 7, 0, 0, 0, 1), (0, 9, 9, 0, 0, 0, 1)]
# A name that only sometimes means something apart does not outweigh long text without links.
_NAMED_BODY = [(1, 75, 0, 1, 0, 0, 0), (1, 100, 2, 1, 0, 0, 0), (1, 140, 0, 1, 0, 0, 0), (1, 65, 1, 1, 0, 0, 0)]
_NAMED_ARTICLE = [(1, 70, 0, 1, 1, 0, 0), (1, 90, 1, 1, 1, 0, 0), (1, 120, 0, 1, 1, 0, 0)]
# References at the end of an article.
_REFERENCES = [(1, 1, 0, 0, 1, 1, 0), (1, 6, 6, 0, 1, 0, 1), (1, 8, 8, 0, 1, 0, 1), (1, 6, 6, 0, 1, 0, 1), (1, 8, 8, 0, 1, 0, 1), (1, 9, 9, 0, 1, 0, 1), (1, 8, 8, 0, 1, 0, 1)]
LABELLED = [
    _NAV + _AD + _ARTICLE + _FOOT,
    _NAV + _LONG_AD + _ARTICLE[:3] + _IN_ARTICLE + _ARTICLE[3:] + _COMMENTS + _FOOT,
    _NAV + _AD + _SHORT_ARTICLE + _FOOT,
    _NAV + _SHORT_ARTICLE + _COMMENTS + _FOOT,
    _ARTICLE + _IN_ARTICLE,
    _PLAIN_NAV + _ARTICLE + _RELATED + _PLAIN_FOOT,
    _PLAIN_NAV + _BODY + _RELATED + _PLAIN_FOOT,
    _PLAIN_NAV + _PLAIN_NAV + _BODY[:4] + _LONG_AD + _BODY[4:] + _COMMENTS + _PLAIN_FOOT,
    _NAV + _BODY + _FOOT,
    _BODY,
    _AD + _COMMENTS + _FOOT,
    _NAV + _ARTICLE[:3],
    _ARTICLE[:1],
    _ARTICLE[2:3],
    _NAV + _ARTICLE[4:5],
    _SHORT_ARTICLE,
    _PLAIN_NAV + _ARTICLE[:2] + _SHORT_ARTICLE[1:],
    _NAV + _LINKED_ARTICLE + _FOOT,
    _LINKED_ARTICLE[::-1],
    _NAV + _NAMED_BODY + _FOOT,
    _NAV + _ARTICLE[:2] + _NAMED_ARTICLE + _ARTICLE[3:5] + _FOOT,
    _NAV + _ARTICLE[:4] + _REFERENCES + _COMMENTS + _FOOT,
    _NAV + _ARTICLE[:4] + _BOX + _ARTICLE[4:] + _FOOT,
    _PLAIN_NAV + _SPARSE_BODY + _RELATED + _PLAIN_FOOT,
    _NAV + _SPARSE_BODY + _COMMENTS + _FOOT,
    _NAV + _ASIDE + _ARTICLE[:2] + _FOOT,
]


class Node(NamedTuple):
    feature: int  # -1: a leaf
    threshold: float
    low: "Node | None"  # rows with a value of at most the threshold
    high: "Node | None"
    keep: bool


def train_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 1) -> Node:
    """A CART decision tree: the split of least Gini impurity at each node (ties: first feature, lowest threshold)."""
    keep = bool(labels.mean() >= 0.5)
    if depth == 0 or labels.all() or not labels.any():
        return Node(-1, 0.0, None, None, keep)
    best = None
    for f in range(rows.shape[1]):
        order = np.argsort(rows[:, f], kind="stable")
        values, kept = rows[order, f], labels[order].astype(float)
        cuts = np.flatnonzero(values[1:] > values[:-1]) + 1
        cuts = cuts[(cuts >= least) & (cuts <= len(values) - least)]
        if not len(cuts):
            continue
        low, n = np.cumsum(kept)[cuts - 1], len(values)
        high, n_low, n_high = kept.sum() - low, cuts, len(values) - cuts
        impurity = (low * (1 - low / n_low) + high * (1 - high / n_high)) / n
        at = int(impurity.argmin())
        if best is None or impurity[at] < best[0] - 1e-12:
            best = impurity[at], f, (values[cuts[at] - 1] + values[cuts[at]]) / 2
    if best is None:
        return Node(-1, 0.0, None, None, keep)
    _, f, threshold = best
    low = rows[:, f] <= threshold
    return Node(f, threshold, train_tree(rows[low], labels[low], depth - 1, least),
                train_tree(rows[~low], labels[~low], depth - 1, least), keep)


def labelled_rows() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of :data:`LABELLED`."""
    pages = [[Block("", w, linked, apart, article, heading, listed) for _, w, linked, apart, article, heading, listed in page]
             for page in LABELLED]
    return np.vstack([features(p) for p in pages]), np.array([bool(b[0]) for page in LABELLED for b in page])


def classify(tree: Node, rows: np.ndarray) -> np.ndarray:
    """Whether each row of features is main text."""
    keep = np.zeros(len(rows), bool)
    todo = [(tree, np.arange(len(rows)))]
    while todo:
        node, at = todo.pop()
        if node.feature < 0:
            keep[at] = node.keep
        elif len(at):
            low = rows[at, node.feature] <= node.threshold
            todo += [(node.low, at[low]), (node.high, at[~low])]
    return keep


def _extractor(tree: Node):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, column="html")):
            pages = [blocks(p) for p in batch.column("html").to_pylist()]
            sizes = np.cumsum([0, *map(len, pages)])
            keep = classify(tree, np.vstack([features(p) for p in pages])) if pages else np.zeros(0, bool)
            texts = [" ".join(b.text for b, k in zip(p, keep[a:].tolist()) if k) for p, a in zip(pages, sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 tree: Node | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. ``tree``: a classifier other than the labelled table's."""
    tree = tree or train_tree(*labelled_rows())
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = dict(rows.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return map_batches(rows, _extractor(tree), schema)
