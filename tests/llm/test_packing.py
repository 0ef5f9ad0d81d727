import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from regspan.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected_pieces(rows):
    encode = library().encode
    out = Counter()
    for doc_id, text in rows:
        ids = encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            out[doc_id, piece, start, len(part), crc] += 1
    return out


def check(docs):
    rows = packing.packed(docs, PATH).collect()
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(r)[:5] for r in rows) == expected_pieces(texts)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for used in places.values():
        at = 0
        for offset, length in sorted(used):
            assert offset == at
            at += length
        assert at <= 4096
    return len(places), sum(r.length for r in rows)


def test_given_table(given):
    sequences, tokens = check(given)
    assert sequences <= tokens / 4096 * 1.01 + 1


def test_odd_rows(odd, clashing, empty):
    check(odd)
    assert packing.packed(clashing, PATH).count() == packing.packed(odd, PATH).count()
    assert packing.packed(empty, PATH).count() == 0


def test_ids_on_request(docs_of):
    row = packing.packed(docs_of(["some words here"]), PATH, with_ids=True).first()
    assert len(row.ids) == 4 * row.length and zlib.crc32(bytes(row.ids)) == row.ids_crc32


def one_by_one(lengths, capacity):
    """Best-fit decreasing without groups: the number of sequences."""
    free = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in free if r >= length]
        room = min(fits, default=capacity)
        if fits:
            free.remove(room)
        free.append(room - length)
    return len(free)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_and_places_every_rank_once(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 37, 100])
    lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 200))]
    lengths += [r.randint(1, capacity)] * r.randint(0, 90)
    counts = Counter(lengths)
    used, ranks = defaultdict(list), defaultdict(list)
    for length, lo, hi, first, each, at in packing.plan_slots(counts, capacity):
        for rank in range(lo, hi):
            ranks[length].append(rank)
            place = rank - lo
            used[first + place // each].append((at + place % each * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == one_by_one(lengths, capacity)


def test_plan_size_does_not_grow_with_the_counts():
    counts = {n: 1 + n * 7 % 13 for n in range(1, 4097)}
    small = packing.plan_slots(counts)
    large = packing.plan_slots({n: c * 1_000_003 for n, c in counts.items()})
    assert len(large) < 30_000 and len(small) < 30_000
