"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once, tag by tag, into blocks of text. Each block is described by its own number
of words and link density, those of its neighbours, and the elements around it: whether they are
page furniture by kind or by class name, and whether they are an article. A decision tree, grown
here on a small labelled table of such blocks, says which blocks are main text.

Rows are independent, so the work is one pass over Arrow batches without a shuffle; the tree is a
few nodes and travels with the task.

Defined cases: null or empty html, and pages without main text, give an empty text; text outside
any element is a block; unclosed elements end with their parent; unclosed scripts, styles and
comments run to the end of the page; repeated rows are extracted alike; empty tables give no rows;
other columns pass through, and those named like the outputs are replaced.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tenderloom.llm import frames

#: elements whose content is no text
_SILENT = frozenset("script style noscript template textarea svg math iframe object select button audio video canvas map".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split())
_FURNITURE = frozenset("nav header footer aside form menu dialog fieldset head title".split())
_ARTICLE = frozenset("article main".split())
#: elements that an element of the same group ends
_SIBLINGS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
#: names of classes, ids and roles that mark page furniture, and those that mark the article
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|notices?|"
    r"alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|comments?|disqus|reply|"
    r"replies|respond|sidebar|side(?=$|\s)|widget|related|recommend(?:ed|ations)?|trending|popular|menu|nav|navbar|navigation|"
    r"breadcrumbs?|pagination|pager|footer|foot|header|masthead|topbar|toolbar|copyright|legal|disclaimer|search|tags?|"
    r"byline|contentinfo|complementary|hidden)(?:$|[\s_\d-])", re.I)
_BODY_NAMES = re.compile(r"(?:^|[\s_-])(?:article|article-?body|post-?body|post-?content|entry-?content|story|story-?body|main-?content|body-?text)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<[!?](?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)>"
    r"|(?P<text>[^<]+|<)", re.S)
_NAMED = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "furniture", "article", "heading")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: int
    article: int
    heading: int


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []          # element, furniture depth, article depth
    pieces: list[str] = []
    linked_pieces: list[str] = []
    anchors = furniture = article = opened = 0      # a link ends with the element it was opened in

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            names = [e[0] for e in stack]
            out.append(Block(text, len(text.split()), len("".join(linked_pieces).split()), int(furniture > 0), int(article > 0),
                             int(bool(names) and re.fullmatch("h[1-6]", names[-1]) is not None)))
        pieces.clear()
        linked_pieces.clear()

    def leave(count: int) -> None:
        nonlocal furniture, article, anchors
        for _ in range(count):
            _, f, a = stack.pop()
            furniture -= f
            article -= a
        if len(stack) < opened:
            anchors = 0

    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        if m["text"] is not None:
            text = entities.unescape(m["text"])
            pieces.append(text)
            if anchors:
                linked_pieces.append(text)
            continue
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing, rest = bool(m["close"] or m["close2"]), m["rest"] or m["rest2"] or ""
        if name in _SILENT:
            if not closing and not rest.endswith("/"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "a":
            anchors, opened = 0 if closing else 1, len(stack)
        if name == "br":
            pieces.append(" ")
            if anchors:
                linked_pieces.append(" ")
        if name in _INLINE:
            continue
        flush()                     # a link may hold whole blocks
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    leave(len(stack) - depth)
                    break
            continue
        while stack and stack[-1][0] in _SIBLINGS.get(name, {"p"}):     # any block ends a paragraph
            leave(1)
        if name in _VOID or rest.endswith("/"):
            continue
        said = " ".join(x for group in _NAMED.findall(rest) for x in group if x)
        within_article = article > 0
        f = int(name in _FURNITURE and not (name == "header" and within_article) or bool(_HIDDEN.search(rest))
                or bool(said and _NAMES.search(said) and name not in ("body", "html") and not _BODY_NAMES.search(said)))
        a = int(name in _ARTICLE or bool(said and _BODY_NAMES.search(said)))
        stack.append((name, f, a))
        furniture += f
        article += a
    flush()
    return out


def described(blocks: list[Block]) -> np.ndarray:
    """FEATURES of every block; beyond the ends of the page there are no words."""
    words = np.array([0, *(b.words for b in blocks), 0], np.float64)
    density = np.array([0, *(b.linked / b.words for b in blocks), 0], np.float64)
    return np.column_stack([
        words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:],
        [b.furniture for b in blocks], [b.article for b in blocks], [b.heading for b in blocks]])


# labelled blocks: words, link density, the same of the block before and of the block after, inside
# page furniture, inside an article, heading; 1 for main text
LABELLED = (
    # menus, footers, notices, sidebars and reader comments, by the elements around them
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 3, 1.0, 9, 0.0, 1, 0, 0, 0),
    (9, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 0), (12, 0.0, 40, 0.0, 0, 0.0, 1, 0, 0, 0), (31, 0.1, 60, 0.0, 0, 0.0, 1, 0, 0, 0),
    (25, 0.0, 80, 0.0, 30, 0.0, 1, 0, 0, 0), (44, 0.0, 25, 0.0, 12, 0.0, 1, 0, 0, 0), (90, 0.0, 120, 0.0, 60, 0.0, 1, 0, 0, 0),
    (6, 0.0, 70, 0.0, 55, 0.0, 1, 1, 0, 0), (15, 0.0, 66, 0.0, 48, 0.0, 1, 1, 0, 0), (40, 0.0, 66, 0.0, 22, 0.0, 1, 1, 0, 0),
    (70, 0.0, 40, 0.0, 35, 0.0, 1, 1, 0, 0), (3, 0.0, 5, 0.0, 30, 0.0, 1, 0, 1, 0), (4, 0.0, 0, 0.0, 45, 0.0, 1, 1, 1, 0),
    (5, 1.0, 6, 1.0, 4, 1.0, 1, 1, 0, 0), (120, 0.0, 8, 0.0, 10, 0.5, 1, 1, 0, 0), (18, 0.4, 20, 0.3, 22, 0.3, 1, 0, 0, 0),
    # the article, down to paragraphs of one word
    (8, 0.0, 1, 1.0, 60, 0.0, 0, 1, 1, 1), (5, 0.0, 0, 0.0, 20, 0.0, 0, 1, 1, 1), (1, 0.0, 90, 0.0, 70, 0.0, 0, 1, 0, 1),
    (2, 0.0, 8, 0.0, 12, 0.0, 0, 1, 0, 1), (7, 0.0, 30, 0.0, 0, 0.0, 0, 1, 0, 1), (35, 0.0, 8, 0.0, 44, 0.0, 0, 1, 0, 1),
    (60, 0.05, 35, 0.0, 1, 0.0, 0, 1, 0, 1), (140, 0.0, 60, 0.0, 80, 0.0, 0, 1, 0, 1), (12, 0.25, 50, 0.0, 40, 0.1, 0, 1, 0, 1),
    (22, 0.5, 50, 0.0, 40, 0.1, 0, 1, 0, 1), (3, 0.0, 2, 0.0, 4, 0.0, 0, 1, 0, 1), (16, 0.0, 9, 0.0, 14, 0.0, 0, 1, 0, 1),
    (6, 0.0, 40, 0.0, 3, 1.0, 0, 1, 0, 1), (2, 0.0, 12, 0.0, 2, 1.0, 0, 1, 0, 1), (9, 0.0, 30, 0.0, 1, 1.0, 0, 1, 0, 1),
    (4, 0.0, 0, 0.0, 2, 1.0, 0, 1, 1, 1), (1, 0.0, 3, 1.0, 5, 0.8, 0, 1, 0, 1), (11, 0.0, 2, 1.0, 3, 1.0, 0, 1, 0, 1),
    (5, 0.0, 1, 1.0, 0, 0.0, 0, 1, 0, 1), (3, 0.3, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (10, 0.4, 6, 0.0, 2, 1.0, 0, 1, 0, 1),
    # lists of links and single links inside an article element
    (3, 1.0, 2, 1.0, 3, 1.0, 0, 1, 0, 0), (4, 1.0, 60, 0.0, 5, 1.0, 0, 1, 0, 0), (2, 1.0, 40, 0.0, 0, 0.0, 0, 1, 0, 0),
    (8, 0.9, 7, 0.9, 9, 1.0, 0, 1, 0, 0),
    # pages without article elements: long texts and what stands between them
    (45, 0.0, 5, 0.0, 60, 0.0, 0, 0, 0, 1), (80, 0.04, 45, 0.0, 33, 0.0, 0, 0, 0, 1), (28, 0.0, 50, 0.0, 6, 0.8, 0, 0, 0, 1),
    (24, 0.1, 9, 0.0, 30, 0.0, 0, 0, 0, 1), (6, 0.0, 70, 0.0, 55, 0.0, 0, 0, 0, 1), (4, 0.0, 33, 0.0, 41, 0.0, 0, 0, 0, 1),
    (9, 0.0, 40, 0.0, 28, 0.1, 0, 0, 0, 1), (7, 0.0, 2, 1.0, 48, 0.0, 0, 0, 1, 1), (5, 0.0, 30, 0.0, 36, 0.0, 0, 0, 1, 1),
    (16, 0.0, 18, 0.0, 40, 0.0, 0, 0, 0, 1), (19, 0.0, 44, 0.0, 3, 1.0, 0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (3, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (10, 0.7, 50, 0.0, 3, 1.0, 0, 0, 0, 0),
    (14, 0.6, 3, 1.0, 12, 0.6, 0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (6, 0.3, 3, 1.0, 5, 0.6, 0, 0, 0, 0),
    (3, 0.0, 4, 0.0, 5, 0.0, 0, 0, 0, 0), (4, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0, 0), (6, 0.0, 0, 0.0, 3, 0.0, 0, 0, 0, 0),
    (5, 0.0, 2, 0.5, 2, 0.0, 0, 0, 0, 0), (7, 0.0, 1, 1.0, 4, 0.0, 0, 0, 0, 0), (8, 0.0, 9, 0.0, 0, 0.0, 0, 0, 0, 0),
    (5, 0.0, 3, 1.0, 2, 1.0, 0, 0, 1, 0), (8, 0.2, 5, 0.8, 0, 0.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 4, 1.0, 0, 0, 0, 0),
)


@dataclass
class Node:
    value: int                  # the label here, if there is no split
    feature: int = -1
    at: float = 0.0             # values up to this go left
    left: "Node | None" = None
    right: "Node | None" = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """A decision tree by Gini impurity; ties go to the first feature and the lowest cut."""
    node = Node(int(2 * y.sum() >= len(y)))
    if depth == 0 or y.min() == y.max():
        return node
    best = len(y) * 2 * y.mean() * (1 - y.mean()) - 1e-9
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            left = x[:, f] <= cut
            impurity = sum(len(p) * 2 * p.mean() * (1 - p.mean()) for p in (y[left], y[~left]))
            if impurity < best - 1e-9:
                best, node.feature, node.at = impurity, f, float(cut)
    if node.feature >= 0:
        left = x[:, node.feature] <= node.at
        node.left, node.right = grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1)
    return node


def train(table=LABELLED) -> Node:
    rows = np.array(table, np.float64)
    return grow(rows[:, :-1], rows[:, -1].astype(int))


def decide(tree: Node, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node.feature < 0:
            out[rows] = node.value
        elif len(rows):
            left = x[rows, node.feature] <= node.at
            todo += [(node.left, rows[left]), (node.right, rows[~left])]
    return out


def extract(page: str | None, tree: Node) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n".join(b.text for b, main in zip(blocks, decide(tree, described(blocks))) if main)


def extract_text(pages: DataFrame, *, html: str = "html", table=LABELLED) -> DataFrame:
    """The pages with text and n_chars (its code points), without the html."""
    tree = train(table)

    def run(column: pa.Array) -> list[pa.Array]:
        texts = [extract(p, tree) for p in column.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return frames.map_texts(pages, html, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], run, keep=False)
