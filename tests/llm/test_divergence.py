"""Source divergence audit against a dense brute force and its SQL."""

import re
from collections import Counter

import pytest

from checks.compare import differences, duckdb_on
from regspan.llm import divergence, oracles

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCALE = 10**9


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, top=200):
    """(lang, source, part, item, value, rank) from (text, lang, source) rows, term by term."""
    docs = [((lang or ""), (source or ""), terms(text)) for text, lang, source in rows]
    held = Counter((lang, t) for lang, _, ts in docs for t in set(ts))
    kept = {}
    for (lang, t), n in held.items():
        if n >= 3:
            kept.setdefault(lang, set()).add(t)
    counts = {}
    for lang, source, ts in docs:
        bag = counts.setdefault((lang, source), Counter())
        bag.update(t for t in ts if t in kept.get(lang, ()))
    out = []
    for (lang, source), bag in counts.items():
        vocab = kept.get(lang, set())

        def p(b):
            total = sum(b.values()) + len(vocab)
            return {t: 1 + SCALE * (b[t] + 1) // total for t in vocab}

        mine = p(bag)
        pairs = []
        for (l2, other), bag2 in counts.items():
            if l2 == lang and other != source:
                q = p(bag2)
                pairs.append((other, sum((mine[t] - q[t]) ** 2 // q[t] for t in vocab)))
        whole = sum((b for (l2, _), b in counts.items() if l2 == lang), Counter())
        q = p(whole)
        listed = [(t, (mine[t] - q[t]) ** 2 // q[t]) for t in vocab if bag[t] > 0 and mine[t] > q[t]]
        for part, items, cap in (("pair", pairs, None), ("term", listed, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:cap]
            out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_given_table_against_sql_and_brute(spark, sf_dir):
    from regspan.llm.common import table

    found = divergence.query(spark, sf_dir)
    assert not differences(found, duckdb_on(sf_dir), oracles.oracle_sql()["op12_divergence"])
    docs = table(spark, sf_dir, "documents").collect()
    assert rows_of(found) == brute([(r.text, r.lang, r.source) for r in docs])


def small(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string, doc_id long")


@pytest.fixture(scope="module")
def mixed(spark):
    rows = []
    for i in range(40):
        src = ["a", "b", "c", None][i % 4]
        rows.append((f"the cat Cat dog {'bird ' * (i % 3)}été 日本 x{i} 12 fish{i % 5}", "en", src, i))
    rows += [(None, None, None, 100), ("", "en", "empty", 101), ("only once words", "fr", "z", 102)]
    rows += [("le chat le chien", "fr", s, 200 + i) for i, s in enumerate("pqrpq")]
    rows += rows[:6]  # repeated rows
    return small(spark, rows)


def test_odd_and_repeated_rows(mixed):
    rows = [(r.text, r.lang, r.source) for r in mixed.collect()]
    assert rows_of(divergence.audit(mixed)) == brute(rows)


def test_small_blocks_and_clashing_columns(mixed, monkeypatch):
    """Blocks of a few terms, many trees per language; extra columns of any name."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "LEAF", 2)
    clashing = mixed.withColumns({n: F.lit(n) for n in ["terms", "tid", "count", "p", "total", "block"]})
    rows = [(r.text, r.lang, r.source) for r in mixed.collect()]
    assert rows_of(divergence.audit(clashing)) == brute(rows)


def test_empty(empty):
    assert divergence.audit(empty).count() == 0


def test_forest_shares_equal_subtrees(monkeypatch):
    monkeypatch.setattr(divergence, "LEAF", 16)  # four leaves under the root
    forest = divergence.Forest(64)
    import numpy as np

    a = forest.tree(np.array([1, 40]), np.array([3, 5]))
    b = forest.tree(np.array([1, 40]), np.array([3, 5]))
    c = forest.tree(np.array([1, 41]), np.array([3, 5]))
    assert a == b != c
    # the left halves of a and c are one node
    assert forest.kids[a][1] == forest.kids[c][1]
