"""Hierarchical packing: every id once, in order, sequences full or a power of two, no padding."""

import zlib
from array import array
from collections import defaultdict

import pytest

from regspan.llm import tiers

TOKENIZER = "byte_bpe_50k.json"


def ids_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def check(docs, result):
    """Pieces of each row tile its ids, by crc32; sequences are gapless, full or powers of two."""
    rows = result.collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    texts = defaultdict(list)
    for d in docs.collect():
        texts[d.doc_id].append(d.text)
    for doc_id, found in by_doc.items():
        wanted = sorted(len(ids_of(t)) for t in texts[doc_id])
        # rows of equal doc_id with equal texts cannot be told apart: compare as a whole
        assert sum(r.length for r in found) == sum(wanted)
        assert {r.doc_tokens for r in found} == set(wanted)
    for doc_id, ts in texts.items():
        if len(set(ts)) == 1:
            ids = ids_of(ts[0])
            for r in by_doc[doc_id]:
                chunk = array("I", ids[r.start : r.start + r.length]).tobytes()
                assert zlib.crc32(chunk) == r.ids_crc32
            covered = sorted((r.start, r.start + r.length) for r in by_doc[doc_id])
            assert sum(b - a for a, b in covered) == len(ids) * len(ts)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length, r.tier))
    for parts in sequences.values():
        parts.sort()
        at = 0
        for offset, length, _ in parts:
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0  # full or a power of two: no padding
        assert {tier for _, _, tier in parts} == {at}
    return rows


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def test_given_table(given, path):
    rows = check(given, tiers.packed(given, path))
    lengths = defaultdict(int)
    for r in rows:
        lengths[r.sequence_id] += r.length
    # only the last window of each step group is split: few sequences below 1024
    assert sum(1 for v in lengths.values() if v < 1024) <= 11 * (1 + len({r.step_group for r in rows}))


def test_odd_and_clashing(odd, clashing, empty, path):
    check(odd, tiers.packed(odd, path))
    check(odd, tiers.packed(clashing, path))
    assert tiers.packed(empty, path).count() == 0


def test_many_groups(docs_of, path, monkeypatch):
    monkeypatch.setattr(tiers, "GROUP_TOKENS", 300)
    docs = docs_of([("word " * (i * 37 % 900)).strip() for i in range(120)])
    check(docs, tiers.packed(docs, path))


def test_plan_fills_gaps_and_splits_the_rest():
    lengths = [600, 700, 300, 200, 100, 50, 120, 128, 1, 1000]
    sequences = tiers.plan(lengths)
    taken = defaultdict(list)
    for content in sequences:
        size = sum(b - a for _, a, b in content)
        assert size == 1024 or size & (size - 1) == 0
        for i, a, b in content:
            taken[i].append((a, b))
    for i, n in enumerate(lengths):
        spans = sorted(taken[i])
        assert spans[0][0] == 0 and spans[-1][1] == n
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    assert sum(1 for c in sequences if sum(b - a for _, a, b in c) < 1024) <= 10
