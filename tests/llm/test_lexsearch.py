"""Ranked lexical search against a brute force by the contract's integer formula, and its SQL."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from checks.compare import differences, duckdb_on
from regspan.llm import lexsearch, oracles

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    folded = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return TERM.findall(folded)


def brute(docs, items, top=10):
    """(item_id, rank, doc_id, score) for every item, every document scored."""
    bags = [(doc_id, Counter(terms(text)), len(terms(text))) for doc_id, text in docs]
    big_n = sum(1 for _, _, n in bags if n)
    big_l = sum(n for _, _, n in bags)
    if not big_n:
        return []
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item_id, text in items:
        asked = {t for t in terms(text) if df[t]}
        w = {t: math.floor(1000.0 * math.log((2.0 * big_n + 2.0) / (2.0 * df[t] + 1.0))) for t in asked}
        scored = []
        for doc_id, bag, n in bags:
            m = 10 + (90 * n * big_n) // big_l
            score = sum(w[t] * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in asked if bag[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, no_id, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, rank, None if no_id else doc_id, -score))
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def sorted(rows, key=None):  # NULL doc_ids compare last
    import builtins

    return builtins.sorted(rows, key=key or (lambda r: tuple((x is None, x or 0) for x in r)))


@pytest.fixture(scope="module")
def items(spark):
    texts = [
        "the cat sat", "Cat DOG bird", "", None, "été 日本語", "zzz unknown", "a b c d e f g h",
        "the the the", "x" * 5000,
    ]
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_given_tables_against_sql(spark, sf_dir):
    from regspan.llm.common import table

    found = lexsearch.query(spark, sf_dir)
    assert not differences(found, duckdb_on(sf_dir), oracles.oracle_sql()["op11_lexsearch"])
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    assert rows_of(found) == sorted(brute(docs, items))


def test_odd_rows(spark, odd, items):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    its = [(r.item_id, r.text) for r in items.collect()]
    assert rows_of(lexsearch.search(odd, items)) == sorted(brute(docs, its))


def test_clashing_and_empty(clashing, empty, items, odd):
    assert rows_of(lexsearch.search(clashing, items)) == rows_of(lexsearch.search(odd, items))
    assert lexsearch.search(empty, items).count() == 0
    assert lexsearch.search(odd, items.limit(0)).count() == 0


def test_ties_and_many_groups(spark, docs_of, items, monkeypatch):
    """Hundreds of equal documents, several groups and query blocks: ties by doc_id."""
    rng = np.random.default_rng(3)
    words = ["cat", "dog", "bird", "the", "sat", "fish", "tree"]
    texts = [" ".join(rng.choice(words, size=rng.integers(1, 30))) for _ in range(300)]
    texts += ["the cat sat"] * 200 + ["Cat dog bird bird"] * 50
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    rows += rows[:20]  # repeated rows
    docs = docs_of(rows)
    monkeypatch.setattr(lexsearch, "GROUP_ENTRIES", 150)
    monkeypatch.setattr(lexsearch, "QUERY_BLOCK", 2)
    monkeypatch.setattr(lexsearch, "LEAF", 4)
    its = [(r.item_id, r.text) for r in items.collect()]
    assert rows_of(lexsearch.search(docs, items)) == sorted(brute(rows, its))


def test_keys_dealt_over_many_partitions(spark, docs_of, monkeypatch):
    """Groups meet their queries also where no partitions are merged; an item may have no id."""
    monkeypatch.setattr(lexsearch, "GROUP_ENTRIES", 40)
    rows = [(i, f"the cat{i % 7} sat on dog{i % 11} " + "bird " * (i % 5)) for i in range(120)]
    items = [(0, "cat1 bird"), (None, "dog3 cat2"), (2**53 + 1, "the dog5 bird")]
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merging)
    spark.conf.set(merging, "false")
    try:
        found = rows_of(lexsearch.search(docs_of(rows), spark.createDataFrame(items, "item_id long, text string")))
    finally:
        spark.conf.set(merging, before)
    assert found == sorted(brute(rows, items))


def test_tree_search_is_exact():
    """The tree alone against all rows, on random sparse vectors with ties."""
    rng = np.random.default_rng(7)
    n, dims = 400, 30
    dense = rng.integers(0, 4, size=(n, dims)) * (rng.random((n, dims)) < 0.2)
    dense[np.arange(n), rng.integers(0, dims, n)] += 1  # no empty row
    dense[100:160] = dense[99]
    indptr = np.concatenate([[0], np.cumsum((dense > 0).sum(1))])
    idx = np.nonzero(dense)[1]
    val = dense[dense > 0].astype(np.int64)
    tree = lexsearch.BallTree(indptr, idx, val.astype(float), dims)

    def score_rows(rows, q_terms, q_w):
        q = np.zeros(dims, dtype=np.int64)
        q[q_terms] = q_w
        return dense[rows] @ q

    for _ in range(50):
        q_terms = rng.choice(dims, size=rng.integers(1, 6), replace=False)
        q_w = rng.integers(1, 1000, size=len(q_terms))
        q = np.zeros(dims, dtype=np.int64)
        q[q_terms] = q_w
        scores = dense @ q
        want = sorted(((-s, r) for r, s in enumerate(scores) if s > 0))[:10]
        got = tree.search(q_terms, q_w, score_rows)
        assert got == [(-s, r) for s, r in want]
