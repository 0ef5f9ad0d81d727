import hashlib
import random

from regspan.llm import suffixes


def brute(rows, length):
    """Removed bytes by definition, documents in order of id."""
    seen, out = set(), {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            part = data[s : s + length]
            if part in seen:
                gone[s : s + length] = [True] * length
            seen.add(part)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    return {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in df.collect()
        if r.doc_id is not None
    }


def test_given_table(given):
    rows = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    assert found(suffixes.repeated_spans(given)) == brute(rows, 100)


def test_random_texts_of_few_letters(docs_of):
    random.seed(5)
    rows = [
        (i, "".join(random.choice("abé ") for _ in range(random.randrange(0, 400))))
        for i in range(60)
    ]
    rows += [(100 + i, rows[i % 7][1][i : i + 90] + "q" + rows[3][1]) for i in range(20)]
    rows += [(200, "ab" * 300), (201, "ab" * 80), (202, "x" * 700), (203, "x" * 39)]
    for length in (8, 40, 100):
        assert found(suffixes.repeated_spans(docs_of(rows), length)) == brute(rows, length)


def test_many_copies_and_one_common_passage(docs_of):
    passage = "A passage that many documents share, and which is longer than one hundred bytes, as it must be to count."
    rows = [(i, f"{i * 7919} start {passage} end {i * 104729}") for i in range(300)]
    rows += [(1000 + i, rows[4][1]) for i in range(300)]
    got = found(suffixes.repeated_spans(docs_of(rows)))
    assert got == brute(rows, 100)
    assert all(got[1000 + i][1] == len(rows[4][1].encode()) for i in range(300))


def test_odd_rows(odd, clashing, empty):
    got = suffixes.repeated_spans(odd).collect()
    assert len(got) == odd.count()
    assert next(r for r in got if r.doc_id is None).n_removed == 0
    assert sorted(map(str, suffixes.repeated_spans(clashing).collect())) == sorted(map(str, got))
    assert suffixes.repeated_spans(empty).count() == 0
