"""Main text of web pages from flat text blocks.

A page is cut into blocks of text at block-level tags. Each block is described by its number of words, the share of them in
links, the same of the blocks before and after it, and by what the elements around it say (article, navigation, a class that
names an advert). A decision tree, grown here on the small labelled table ``BLOCKS``, keeps or drops each block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakekit.llm.arrow_text import Carried, arrow_batches, chunks

# Elements of HTML by how they treat their text.
HIDDEN = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math object select button option head".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var img wbr".split())
SIDE = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
WHOLE = frozenset("html body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Parts of class, id and role names that mark what is not the article.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments comment-list consent contentinfo "
    "cookie cookies copyright disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices outbrain "
    "overlay pager pagination popup promo promoted promotion recommended related reply replies respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription taboola teaser toolbar warning widget".split())
MAIN_WORDS = frozenset("article article-body articlebody content-body entry-content main-content post-body post-content story-body".split())

#: words, link share, words before, link share before, words after, link share after, aside, in article, heading; 1: main text.
BLOCKS = [
    # menus, adverts, footers and notices, by their place
    (1, 1.00, 0, 0.00, 1, 1.00, 1, 0, 0, 0), (1, 1.00, 1, 1.00, 1, 1.00, 1, 0, 0, 0), (2, 1.00, 1, 1.00, 30, 0.00, 1, 0, 0, 0),
    (12, 0.00, 1, 1.00, 8, 0.00, 1, 0, 0, 0), (40, 0.00, 1, 1.00, 60, 0.00, 1, 0, 0, 0), (9, 0.00, 55, 0.00, 0, 0.00, 1, 0, 0, 0),
    (14, 0.20, 80, 0.00, 0, 0.00, 1, 0, 0, 0), (60, 0.00, 70, 0.00, 4, 0.00, 1, 0, 0, 0), (3, 0.00, 12, 0.00, 50, 0.00, 1, 0, 1, 0),
    (25, 0.00, 90, 0.00, 20, 0.00, 1, 1, 0, 0), (4, 0.50, 90, 0.00, 70, 0.00, 1, 1, 0, 0), (110, 0.00, 90, 0.00, 70, 0.00, 1, 1, 0, 0),
    (2, 0.00, 30, 0.00, 40, 0.00, 1, 1, 1, 0), (200, 0.02, 3, 0.00, 150, 0.00, 1, 0, 0, 0), (7, 1.00, 45, 0.00, 45, 0.00, 1, 1, 0, 0),
    # paragraphs, headings and short lines of an article
    (6, 0.00, 12, 0.00, 50, 0.00, 0, 1, 1, 1), (2, 0.00, 1, 1.00, 8, 0.00, 0, 1, 1, 1), (50, 0.00, 6, 0.00, 40, 0.00, 0, 1, 0, 1),
    (1, 0.00, 40, 0.00, 35, 0.00, 0, 1, 0, 1), (3, 0.00, 60, 0.00, 9, 0.00, 0, 1, 0, 1), (120, 0.10, 30, 0.00, 0, 0.00, 0, 1, 0, 1),
    (8, 0.50, 40, 0.00, 60, 0.00, 0, 1, 0, 1), (1, 1.00, 40, 0.00, 60, 0.00, 0, 1, 0, 1), (15, 0.00, 0, 0.00, 0, 0.00, 0, 1, 0, 1),
    (4, 1.00, 25, 0.00, 25, 0.10, 0, 1, 0, 1), (300, 0.00, 2, 0.00, 1, 0.00, 0, 1, 0, 1), (5, 0.00, 1, 1.00, 14, 1.00, 0, 1, 0, 1),
    (1, 0.00, 20, 0.00, 0, 0.00, 0, 1, 0, 1), (2, 0.00, 30, 0.00, 0, 0.00, 0, 1, 0, 1), (1, 0.00, 0, 0.00, 0, 0.00, 0, 1, 0, 1),
    (3, 0.00, 1, 0.00, 1, 0.00, 0, 1, 0, 1), (2, 0.00, 1, 1.00, 2, 1.00, 0, 1, 0, 1), (4, 0.00, 6, 0.00, 3, 0.00, 0, 1, 0, 1),
    (9, 0.00, 3, 0.00, 2, 0.00, 0, 1, 0, 1), (12, 0.00, 2, 0.00, 7, 0.00, 0, 1, 0, 1), (1, 0.00, 10, 0.00, 4, 0.00, 0, 1, 0, 1),
    (6, 0.00, 20, 0.00, 6, 0.00, 0, 1, 0, 1), (2, 1.00, 2, 0.00, 2, 0.00, 0, 1, 0, 1), (30, 0.60, 5, 0.00, 5, 0.00, 0, 1, 0, 1),
    # pages without an article element: by words and links
    (8, 0.00, 30, 0.00, 15, 0.00, 0, 0, 0, 1), (6, 0.00, 18, 0.00, 20, 0.00, 0, 0, 0, 1), (9, 0.00, 25, 0.00, 12, 0.00, 0, 0, 0, 1),
    (5, 0.00, 20, 0.00, 14, 0.00, 0, 0, 0, 1), (7, 0.00, 12, 0.00, 16, 0.00, 0, 0, 0, 1), (8, 0.00, 16, 0.00, 9, 0.00, 0, 0, 0, 1),
    (45, 0.00, 5, 0.00, 60, 0.00, 0, 0, 0, 1), (80, 0.05, 40, 0.00, 30, 0.00, 0, 0, 0, 1), (25, 0.00, 70, 0.00, 50, 0.00, 0, 0, 0, 1),
    (18, 0.10, 40, 0.00, 3, 1.00, 0, 0, 0, 1), (60, 0.20, 1, 1.00, 20, 0.00, 0, 0, 0, 1), (150, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 1),
    (6, 0.00, 50, 0.00, 45, 0.00, 0, 0, 0, 1), (3, 0.00, 30, 0.00, 80, 0.00, 0, 0, 0, 1), (7, 0.00, 2, 1.00, 55, 0.00, 0, 0, 1, 1),
    (4, 0.00, 60, 0.00, 40, 0.00, 0, 0, 1, 1), (12, 0.00, 25, 0.00, 30, 0.00, 0, 0, 0, 1), (5, 0.00, 0, 0.00, 40, 0.00, 0, 0, 1, 1),
    (20, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 1), (21, 0.00, 21, 0.00, 0, 0.00, 0, 0, 0, 1), (16, 0.00, 18, 0.00, 0, 0.00, 0, 0, 0, 1),
    (28, 0.00, 4, 1.00, 3, 1.00, 0, 0, 0, 1), (35, 0.10, 2, 1.00, 5, 1.00, 0, 0, 0, 1), (14, 0.00, 30, 0.00, 2, 1.00, 0, 0, 0, 1),
    (90, 0.00, 3, 1.00, 2, 0.00, 0, 0, 0, 1), (50, 0.30, 40, 0.00, 0, 0.00, 0, 0, 0, 1), (24, 0.00, 1, 0.00, 1, 1.00, 0, 0, 0, 1),
    (1, 0.00, 20, 0.00, 0, 0.00, 0, 0, 0, 0), (2, 0.00, 30, 0.00, 0, 0.00, 0, 0, 0, 0), (1, 0.00, 0, 0.00, 0, 0.00, 0, 0, 0, 0),
    (3, 0.00, 1, 0.00, 1, 0.00, 0, 0, 0, 0), (4, 0.00, 6, 0.00, 3, 0.00, 0, 0, 0, 0), (2, 0.00, 5, 1.00, 6, 0.00, 0, 0, 0, 0),
    (1, 1.00, 0, 0.00, 1, 1.00, 0, 0, 0, 0), (2, 1.00, 1, 1.00, 2, 1.00, 0, 0, 0, 0), (3, 1.00, 2, 1.00, 40, 0.00, 0, 0, 0, 0),
    (20, 0.90, 3, 1.00, 4, 1.00, 0, 0, 0, 0), (35, 0.80, 60, 0.00, 2, 1.00, 0, 0, 0, 0), (2, 0.00, 1, 1.00, 1, 1.00, 0, 0, 0, 0),
    (4, 0.00, 2, 1.00, 3, 1.00, 0, 0, 0, 0), (3, 0.00, 2, 0.00, 2, 0.00, 0, 0, 0, 0), (5, 0.00, 1, 1.00, 3, 0.00, 0, 0, 0, 0),
    (6, 0.60, 50, 0.00, 50, 0.00, 0, 0, 0, 0), (1, 0.00, 3, 1.00, 0, 0.00, 0, 0, 0, 0), (8, 1.00, 70, 0.00, 8, 1.00, 0, 0, 0, 0),
]


@dataclass
class Tree:
    """A node of the decision tree: a leaf has a label, an inner node a feature and a bound (below: left)."""

    label: int = 0
    feature: int = -1
    bound: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def __call__(self, row: tuple) -> int:
        node = self
        while node.feature >= 0:
            node = node.left if row[node.feature] < node.bound else node.right
        return node.label


def _impurity(labels: np.ndarray) -> float:
    share = labels.mean() if len(labels) else 0.0
    return len(labels) * share * (1 - share)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8) -> Tree:
    """A tree by least Gini impurity; of equal cuts the first feature and the lowest bound."""
    if depth == 0 or len(set(labels.tolist())) < 2:
        return Tree(label=int(labels.mean() > 0.5))
    best = (_impurity(labels) - 1e-9, None)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for bound in (values[1:] + values[:-1]) / 2:
            below = rows[:, feature] < bound
            left = _impurity(labels[below]) + _impurity(labels[~below])
            if left < best[0]:
                best = (left, (feature, float(bound), below))
    if best[1] is None:
        return Tree(label=int(labels.mean() > 0.5))
    feature, bound, below = best[1]
    return Tree(feature=feature, bound=bound, left=grow(rows[below], labels[below], depth - 1),
                right=grow(rows[~below], labels[~below], depth - 1))


def trained() -> Tree:
    table = np.array(BLOCKS, float)
    return grow(table[:, :-1], table[:, -1].astype(int))


_TAG = re.compile(r"/?([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?")
_NAMED = re.compile(r"(?:^|[\s\"'/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORD = re.compile(r"[^\s_]+")
#: Parts of a name that say that a page has, or has not, what follows them; and elements that no article inside makes main text.
ABOUT, FIRM = frozenset("has no not with without".split()), ("nav", "aside", "footer", "dialog")


def _side_name(word: str) -> bool:
    """Whether a hyphenated name has a part that marks what is not the article, and is not about the page's layout."""
    for part in word.split("-"):
        if part in ABOUT:
            return False
        if part in SIDE_WORDS:
            return True
    return False


def _hint(name: str, attributes: str, in_main: int) -> tuple[int, int]:
    """What an element says of its text: beside the article, in the article."""
    side = name in SIDE or (name == "header" and not in_main)
    main = name in MAIN
    if attributes:
        for found in _NAMED.finditer(attributes):
            words = _WORD.findall((found[1] or found[2] or found[3] or "").lower())
            for word in words:
                main = main or word in MAIN_WORDS
                side = side or word in SIDE_WORDS or ("-" in word and word not in MAIN_WORDS and _side_name(word))
    return int(side and name not in WHOLE), int(main)


def blocks(html: str) -> list[tuple[str, int, int, int, int, int]]:
    """Text, words, words in links, beside, in article, heading of each block; text of hidden elements is left out.

    Tolerates what pages do: unclosed and crossed tags, stray ends, references without semicolon, a page cut anywhere.
    """
    out: list[tuple[str, int, int, int, int, int]] = []
    stack: list[tuple[str, int, int, int, int]] = []  # name, beside, main, link, hidden
    beside = main = link = hidden = heading = 0
    parts: list[str] = []
    linked = articles = 0

    def close() -> None:
        nonlocal parts, linked
        if parts:
            words = "".join(parts).split()
            if words:
                out.append((" ".join(words), len(words), min(linked, len(words)), int(beside > 0), int(main > 0), int(heading > 0)))
        parts, linked = [], 0

    def pop(name: str) -> None:
        nonlocal beside, main, link, hidden, heading
        while stack:
            top, b, m, a, h = stack.pop()
            beside, main, link, hidden = beside - b, main - m, link - a, hidden - h
            heading -= top in HEADINGS
            if top == name:
                return

    open_count: dict[str, int] = {}
    lower = None
    at, size = 0, len(html)
    while at < size:
        cut = html.find("<", at)
        if cut < 0:
            cut = size
        if cut > at and not hidden:
            text = html[at:cut]
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if link:
                linked += len(text.split())
        if cut >= size:
            break
        if html.startswith("<!--", cut):
            end = html.find("-->", cut + 4)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), cut):
            end = html.find(">", cut)
            at = size if end < 0 else end + 1
            continue
        found = _TAG.match(html, cut + 1)
        if not found:  # a plain less-than sign
            if not hidden:
                parts.append("<")
            at = cut + 1
            continue
        name, ending = found[1].lower(), html[cut + 1] == "/"
        at = found.end()
        if html[at - 1] != ">":  # a quote that nothing closes, or the page's end
            end = html.find(">", at)
            at = size if end < 0 else end + 1
        if name not in INLINE:
            close()
        if ending:
            if open_count.get(name, 0):
                before = len(stack)
                for top, *_ in reversed(stack):
                    open_count[top] -= 1
                    before -= 1
                    if top == name:
                        break
                pop(name)
            continue
        if name == "p" and open_count.get("p", 0) and not any(t[0] in ("article", "div", "td", "li") for t in stack[_last(stack, "p"):]):
            for top, *_ in reversed(stack):
                open_count[top] -= 1
                if top == "p":
                    break
            pop("p")
        if name in VOID or found[2].endswith("/"):
            continue
        if name in RAW:
            lower = lower or html.lower()
            if len(lower) != size:  # rare letters change their length
                lower = re.sub("[A-Z]", lambda m: m[0].lower(), html)
            end = lower.find(f"</{name}", at)
            at = size if end < 0 else end
            if end >= 0:
                end = html.find(">", at)
                at = size if end < 0 else end + 1
            continue
        side, inside = _hint(name, found[2], main)
        if name in MAIN:
            # what holds the page's article is a wrapper, whatever its name; a comment may be an article too
            fresh = not main and not side and (name == "main" or not articles) and not any(open_count.get(x, 0) for x in FIRM)
            articles += fresh
            side = -beside if fresh else 0
        entry = (name, side, inside, int(name == "a"), int(name in HIDDEN))
        stack.append(entry)
        open_count[name] = open_count.get(name, 0) + 1
        beside, main, link, hidden = beside + side, main + inside, link + entry[3], hidden + entry[4]
        heading += name in HEADINGS
    close()
    return out


def _last(stack: list[tuple], name: str) -> int:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            return i + 1
    return len(stack)


def main_text(html: str | None, tree: Tree) -> tuple[str, int, int]:
    """The kept blocks joined by one space, how many blocks there are, and how many are kept."""
    found = blocks(html or "")
    size = len(found)
    kept = []
    share = [b[2] / b[1] for b in found]
    for i, (text, words, _, beside, inside, heading) in enumerate(found):
        before = (found[i - 1][1], share[i - 1]) if i else (0, 0.0)
        after = (found[i + 1][1], share[i + 1]) if i + 1 < size else (0, 0.0)
        if tree((words, share[i], *before, *after, beside, inside, heading)):
            kept.append(text)
    return " ".join(kept), size, len(kept)


def extract(pages: DataFrame, *, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all but the html by default) with ``text``, ``n_blocks`` and ``n_kept``.

    White space inside a block becomes one space, character references are decoded, the kept blocks are joined in page order
    by one space. A null or empty page, or one without main text, has an empty text. Kept columns with the names of results
    are left out; repeated rows stay.
    """
    arrow_batches(pages.sparkSession)
    own = ["text", "n_blocks", "n_kept"]
    carried = Carried(pages, html, own, keep, without=(html,) if keep is None else ())
    inner = carried.inner
    tree = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text"):
                texts, n_blocks, n_kept = zip(*(main_text(x, tree) for x in part.column("_text").to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(i) for i in inner), pa.array(texts, pa.string()), pa.array(n_blocks, pa.int64()),
                    pa.array(n_kept, pa.int64())], names=[*inner, *own])

    return carried.through(run, "text string, n_blocks long, n_kept long")
