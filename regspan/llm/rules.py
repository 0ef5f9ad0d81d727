"""Quality rules: counts that reject a document outright, and distribution divergence.

The histogram of character classes of a document, and that of common words, are compared with
references of languages by Jensen-Shannon distance (0 equal, 1 disjoint). A document passes
if some reference is near enough by both. Short documents give unreliable histograms and are
not judged by them. The verdict depends on the document alone, so there is no shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspan.llm.common import row_and, table

SYMBOLS = "#*$%&|<>"  # fixed by the contract
WINDOW = 5

# Classes of bytes. What is not listed is a symbol; bytes beyond ASCII count
# where a character starts.
CLASSES = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "space": " \t\n\r\x0b\x0c",
    "stop": ".,;:!?'\"()-",
}
CLASS_NAMES = (*CLASSES, "symbol", "other")


class Reference(NamedTuple):
    """Shares of character classes (as CLASS_NAMES) and of common words in running text."""

    classes: tuple[float, ...]
    words: dict[str, float]


# Approximate shares in running text of each language, per thousand.
REFERENCES = {
    "en": Reference(
        (790, 25, 5, 165, 14, 1, 0),
        {"the": 60, "of": 30, "and": 28, "to": 25, "a": 21, "in": 20, "is": 11, "that": 11,
         "it": 9, "for": 9, "was": 9, "on": 7, "as": 7, "with": 7, "be": 6, "by": 5},
    ),
    "de": Reference(
        (770, 50, 5, 140, 15, 1, 19),
        {"die": 35, "der": 34, "und": 28, "in": 18, "den": 12, "von": 11, "zu": 11, "das": 11,
         "mit": 9, "sich": 9, "des": 9, "auf": 9, "ist": 8, "im": 8, "dem": 7, "nicht": 7},
    ),
    "fr": Reference(
        (730, 25, 5, 160, 20, 1, 59),
        {"de": 50, "la": 30, "le": 24, "et": 24, "les": 20, "des": 18, "en": 15, "un": 13,
         "du": 12, "une": 11, "que": 10, "est": 10, "pour": 9, "qui": 9, "dans": 9, "par": 7},
    ),
    "es": Reference(
        (760, 25, 5, 165, 15, 1, 29),
        {"de": 60, "la": 38, "que": 30, "el": 29, "en": 27, "y": 25, "a": 19, "los": 17,
         "se": 13, "del": 12, "las": 12, "un": 11, "por": 10, "con": 9, "no": 9, "una": 9},
    ),
}
# Greatest distance that still passes in a long text, what is added to it divided by the root
# of the size (a histogram of few counts is uncertain), and the least size that is judged.
CLASS_LIMIT, CLASS_SLACK, MIN_CHARS = 0.15, 2.2, 250
WORD_LIMIT, WORD_SLACK, MIN_WORDS = 0.30, 0.6, 150

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "class_distance double, word_distance double, base_failed boolean, kept boolean"
)


def _class_of_bytes() -> bytes:
    known = {ord(c): i for i, name in enumerate(CLASSES) for c in CLASSES[name]}
    symbol, other = len(CLASSES), len(CLASSES) + 1
    return bytes(
        known.get(b, symbol if b < 128 else other if b >= 192 else other + 1) for b in range(256)
    )


def js_distance(p, q) -> float:
    """Jensen-Shannon distance of two histograms, base 2: 0 to 1."""
    import numpy as np

    p, q = np.asarray(p, float), np.asarray(q, float)
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def from_mean(x):
        seen = x > 0
        return float((x[seen] * np.log2(x[seen] / m[seen])).sum())

    return max(0.0, (from_mean(p) + from_mean(q)) / 2) ** 0.5


def repeated_words(words: list) -> int:
    """Words in windows of WINDOW words that occur twice or more, each word counted once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == n:
        return 0
    often = {w for w, k in Counter(windows).items() if k > 1}
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if w in often:
            covered += i + WINDOW - max(i, upto)
            upto = i + WINDOW
    return covered


class Judge:
    """The columns of one text; holds what is prepared once per task."""

    def __init__(self, references: dict[str, Reference]):
        self._table = _class_of_bytes()
        self._common = sorted({w for r in references.values() for w in r.words})
        self._place = {w.encode(): i for i, w in enumerate(self._common)}
        self._references = [
            (
                r.classes,
                [r.words.get(w, 0) for w in self._common] + [1000 - sum(r.words.values())],
            )
            for r in references.values()
        ]

    def __call__(self, text: str | None) -> tuple:
        import numpy as np

        data = (text or "").encode()
        words = data.split()  # ASCII white space, as in the contract
        n_words = len(words)
        classes = np.bincount(
            np.frombuffer(data.translate(self._table), np.uint8), minlength=len(CLASS_NAMES) + 1
        )[: len(CLASS_NAMES)]
        n_chars = int(classes.sum())
        word_chars = n_chars - int(classes[CLASS_NAMES.index("space")])
        n_symbols = sum(data.count(s.encode()) for s in SYMBOLS)
        seen, dup_lines = set(), 0
        for line in data.split(b"\n"):
            if line in seen:
                dup_lines += 1
            elif line.strip():
                seen.add(line)
        repeated = repeated_words(words)
        failed = n_words < 10 or 100 * repeated > 20 * n_words
        by_class = by_word = None
        kept = not failed
        if not failed:
            common = [0] * len(self._common)
            for word, k in Counter(data.lower().split()).items():
                if word in self._place:
                    common[self._place[word]] += k
            common.append(n_words - sum(common))
            distances = [(js_distance(classes, c), js_distance(common, w)) for c, w in self._references]
            by_class = min(d for d, _ in distances)
            by_word = min(d for _, d in distances)
            kept = any(
                (n_chars < MIN_CHARS or c <= CLASS_LIMIT + CLASS_SLACK / n_chars**0.5)
                and (n_words < MIN_WORDS or w <= WORD_LIMIT + WORD_SLACK / n_words**0.5)
                for c, w in distances
            )
        return (
            n_words, word_chars, n_symbols, dup_lines, repeated, by_class, by_word, failed, kept,
        )


def judged(text: Column, references: dict[str, Reference] | None = None) -> Column:
    """Struct with COLUMNS for a text column; NULL counts as an empty text.

    base_failed: fewer than 10 words, or more than a fifth of them in repeated windows. The
    distances, each to its nearest reference, are NULL for such texts. Texts below
    MIN_CHARS characters or MIN_WORDS words are not judged by that histogram.
    """
    chosen = references or REFERENCES

    @F.pandas_udf(COLUMNS)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:

        one = Judge(chosen)
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for texts in batches:
            yield pd.DataFrame(map(one, texts), columns=names)

    return judge(text)


def rules(docs: DataFrame, references: dict[str, Reference] | None = None) -> DataFrame:
    """Input rows as struct `row`, with COLUMNS beside it."""
    return row_and(docs, judged=judged(docs["text"], references)).select("row", "judged.*")


def passing(docs: DataFrame, references: dict[str, Reference] | None = None) -> DataFrame:
    """The rows that no rule rejects."""
    return rules(docs, references).where("kept").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: counts and verdict of every document."""
    found = rules(table(spark, sf_dir, "documents"))
    return found.drop("class_distance", "word_distance").select(
        F.col("row.doc_id").alias("doc_id"), "*"
    ).drop("row")
