"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a line of words and tags. Words score by where they stand: weights of the elements,
classes and ids around them, learned from labelled pages, make them positive in main text
and negative in menus, adverts and the like. Tags score negative. One linear scan finds the
contiguous region of the largest sum; blocks in it whose words score negative are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import log
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspan.llm.common import row_and, table
from regspan.llm.labelled_pages import PAGES

# Elements of HTML by how they are read.
RAW = "script style iframe title textarea"  # text up to the end tag, or else of the page
# Containers of what a reader does not see as text, where they are closed within their element.
SKIPPED = frozenset("noscript template object svg select canvas annotation annotation-xml".split())
# A start tag of these ends svg.
_BREAKOUT = frozenset(
    "blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 head hr li menu ol p pre table ul".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# These say nothing by themselves and are often left open.
_LOOSE = frozenset("p li dt dd tr td th tbody thead tfoot html body head hr".split())
_VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
_INLINE_KEPT = frozenset(["button", "label", "option"])

_RAW = "|".join(RAW.split())
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*+)(?:>|\Z)|([^<]++|<)",
    re.S | re.I,
)
_CLOSED_START = re.compile(r"<[A-Za-z]+(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>")
_ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_BOUND = 4.0  # of the score of a word
_DECISIVE = 1.2  # score of an element that settles what is below it
_SMOOTH = 0.1
_UNKNOWN = 0.1  # a word of which nothing is known is rather main text
_OUTSIDE = 0.25  # a word outside main text weighs so much less
_MANY_LINKS = 0.5
_SETTLED = 1.0  # score of the elements around, from which links do not count against a block
_LISTS = (frozenset(["ul"]), frozenset(["ol"]))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Block(NamedTuple):
    text: str
    words: int
    around: tuple[frozenset[str], ...]  # features of the containers, the outermost first
    own: frozenset[str]  # of the block itself
    tags: tuple[str, ...]  # since the block before
    label: str


class Weights(NamedTuple):
    features: dict[str, float]
    tags: dict[str, float]


def _features(name: str, attributes: str) -> tuple[frozenset[str], str]:
    found, label = {name}, ""
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role"):
            found.update("." + w.lower().rstrip("s") for w in _NAME.findall(value))
        elif key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value):
            found.add("hidden")
        elif key == "x":
            label = value
    return frozenset(found), label


def _seen(html: str) -> list[re.Match]:
    """Tokens of a page outside SKIPPED elements.

    One that is not closed before its element ends, or that closes itself (svg), is a tag only.
    """
    tokens: list[re.Match] = []
    open_: list[tuple[str, int]] = []
    count: Counter = Counter()
    spans: list[tuple[int, int]] = []
    pos = 0
    while match := _TOKEN.match(html, pos):
        pos = match.end()
        if match[1] and count["svg"] and (start := _CLOSED_START.match(html, match.start())):
            pos = start.end()  # <title/> and the like, which only svg has
            continue
        i = len(tokens)
        tokens.append(match)
        name = (match[3] or match[6] or "").lower()
        if not name:
            continue
        if match[2] or match[5]:
            if count[name] and name not in _LOOSE:
                while True:
                    top, at = open_.pop()
                    count[top] -= 1
                    if top == name:
                        break
                if name in SKIPPED:
                    spans.append((at, i))
            continue
        while name in _BREAKOUT and open_ and open_[-1][0] == "svg":
            open_.pop()
            count["svg"] -= 1
        closed = name == "svg" and (match[4] or match[7] or "").endswith("/")
        if (name in SKIPPED or name in BLOCKS and name not in _LOOSE and name not in _VOID) and not closed:
            open_.append((name, i))
            count[name] += 1
    out, at = [], 0
    for first, last in sorted(spans):
        if first >= at:
            out += tokens[at:first]
        at = max(at, last + 1)
    return out + tokens[at:]


def blocks(html: str) -> Iterator[Block]:
    """The blocks of a page with words, in order."""
    open_: list[tuple[str, frozenset[str], str]] = []
    own = frozenset()
    pieces: list[str] = []
    linked = link = 0
    tags: list[str] = []
    inline: frozenset[str] = frozenset()

    def close() -> Block | None:
        nonlocal pieces, linked, tags
        words = unescape("".join(pieces)).split()
        pieces = []
        block = None
        if words:
            mine = own.union(inline)
            if linked > _MANY_LINKS * len(words):
                mine |= {"links"}
            label = next((x for _, _, x in reversed(open_) if x), "")
            around = tuple(f for _, f, _ in open_)
            block = Block(" ".join(words), len(words), around, mine, tuple(tags), label)
            tags = []
        linked = 0
        return block

    for match in _seen(html):
        text = match[8]
        if text is not None:
            pieces.append(text)
            if link:
                linked += len(text.split())
            continue
        name = (match[3] or match[6] or "").lower()
        if not name:
            continue
        end = match[2] or match[5]
        if name == "br":
            pieces.append(" ")
        elif name == "a":
            link = 0 if end else 1
        elif name in _INLINE_KEPT:
            if (block := close()) is not None:
                yield block
            inline = frozenset() if end else frozenset([name])
        elif name in BLOCKS:
            if (block := close()) is not None:
                yield block
            tags.append(name)
            link = 0
            if end:
                own = frozenset()
                if any(n == name for n, _, _ in open_):
                    while open_.pop()[0] != name:
                        pass
            else:
                features, label = _features(name, match[4] or match[7] or "")
                if name in _LOOSE:
                    own = features
                elif name not in _VOID:
                    own = frozenset()
                    if name in ("header", "footer") and not any(
                        n in ("article", "main", "section") for n, _, _ in open_
                    ):
                        features |= {"page " + name}
                    open_.append((name, features, label))
    if (block := close()) is not None:
        yield block


def learn(pages: tuple[str, ...] = PAGES) -> Weights:
    """Log odds of main text for the features of words, and (never positive) of tags."""
    words, sums, tags = {True: Counter(), False: Counter()}, Counter(), {True: Counter(), False: Counter()}
    for page in pages:
        for block in blocks(page):
            inside = block.label == "1"
            sums[inside] += 1
            words[inside].update(block.own.union(*block.around))
            tags[inside].update(block.tags)

    def odds(counts, key) -> float:
        yes, no = (counts[True][key] + _SMOOTH) / (sums[True] + 2 * _SMOOTH), (counts[False][key] + _SMOOTH) / (sums[False] + 2 * _SMOOTH)
        return log(yes / no)

    every = set(words[True]) | set(words[False])
    return Weights(
        {k: odds(words, k) for k in every},
        {k: min(-0.1, odds(tags, k)) for k in set(tags[True]) | set(tags[False])},
    )


def word_score(block: Block, weights: Weights) -> float:
    """Score of a word: what is known of the block itself and of the elements around it.

    From the innermost outwards elements are added up to the first that is decisive. Many links,
    and lists without a name, count only where the other elements around, headings aside, do not
    settle it as main text.
    """
    known = weights.features

    def of(features: frozenset[str]) -> float:
        return max(-_BOUND, min(_BOUND, sum(known.get(f, 0.0) for f in features)))

    def around(elements) -> float:
        total = 0.0
        for features in elements:
            score = of(features)
            total += score
            if abs(score) >= _DECISIVE:
                break
        return total

    own, elements = block.own, block.around[::-1]
    others = [f for f in elements if f not in _LISTS]
    if around(f for f in others if not f & _HEADINGS) >= _SETTLED:
        own, elements = own - {"links", "li"}, others
    score = _UNKNOWN + of(own) + around(elements)
    if "hidden" in block.own.union(*block.around):
        score = -_BOUND
    score = max(-_BOUND, min(_BOUND, score))
    return score if score > 0 else _OUTSIDE * score


def main_text(html: str | None, weights: Weights) -> str:
    """Blocks of main text, each with single spaces, joined by one line break."""
    best, start, total = (0.0, 0, 0), 0, 0.0
    scored = [(b, word_score(b, weights)) for b in blocks(html or "")]
    for i, (block, score) in enumerate(scored):
        total += sum(weights.tags.get(t, -0.1) for t in block.tags)
        if total <= 0:
            start, total = i, 0.0
        total += score * block.words
        if total > best[0]:
            best = total, start, i + 1
    return "\n".join(b.text for b, score in scored[best[1] : best[2]] if score > 0)


def extracted(html: Column, weights: Weights | None = None) -> Column:
    """Main text of a column of pages; NULL and pages without any give an empty text."""
    learned = weights or learn()

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p, learned) for p in pages], dtype=object)

    return extract(html)


def main_texts(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Input rows (html and any other columns) as struct `row`, with `text` beside it."""
    return row_and(pages, text=extracted(pages["html"], weights))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: main text of every page."""
    found = main_texts(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("row.page_id").alias("page_id"),
        F.col("row.url").alias("url"),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )
