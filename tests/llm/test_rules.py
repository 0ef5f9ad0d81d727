import re
from collections import Counter

import numpy as np
import pytest

from regspan.llm import rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """The base counts by definition."""
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def judged(docs):
    return [(r.row.text, r) for r in rules.rules(docs).collect()]


def test_counts(given, odd):
    for docs in (given, odd):
        for text, r in judged(docs):
            got = r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
            assert got == counts(text), text
            assert not (r.base_failed and r.kept)


def test_distance():
    assert rules.js_distance([1, 2, 3], [2, 4, 6]) == pytest.approx(0, abs=1e-7)
    assert rules.js_distance([1, 0], [0, 5]) == pytest.approx(1)
    p, q = np.array([0.5, 0.5]), np.array([0.9, 0.1])
    m = (p + q) / 2
    expected = (sum((x * np.log2(x / m)).sum() for x in (p, q)) / 2) ** 0.5
    assert rules.js_distance(p, q) == pytest.approx(expected)


def test_verdicts_against_labels(spark):
    """Clean documents stay, junk goes, as the labels have it."""
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    rows = [r for _, r in judged(docs) if r.row.doc_id in labels and r.n_words >= 10]
    clean = [r.kept for r in rows if labels[r.row.doc_id] == 1]
    junk = [r.kept for r in rows if labels[r.row.doc_id] == 0]
    assert np.mean(clean) >= 0.99 and np.mean(junk) <= 0.2


def test_other_references(docs_of):
    text = "the cat sat on the mat and the dog ran to it " * 1 + "of a big red house by the sea " * 1
    own = {"own": rules.Reference((780, 0, 0, 220, 0, 0, 0), {"the": 200})}
    none = {"none": rules.Reference((0, 0, 1000, 0, 0, 0, 0), {"zz": 500})}
    long = docs_of([" ".join(f"{text} {i} item{i} place{i * 3}" for i in range(12))])
    assert rules.rules(long, own).first().kept is True or rules.rules(long, own).first().base_failed
    assert rules.rules(long, none).first().kept is False


def test_odd_rows(clashing, empty):
    assert rules.passing(clashing).columns == clashing.columns
    assert rules.passing(empty).count() == 0
