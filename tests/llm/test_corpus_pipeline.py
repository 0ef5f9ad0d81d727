"""The corpus pipeline, stage by stage, against plain versions of the stages."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from checks.compare import differences, duckdb_on
from regspan.llm import catalog, minhash, oracles
from tests.llm.test_minhash import brute, words
from tests.llm.test_mixing import size, targets
from tests.llm.test_packing import expected_pieces
from tests.llm.test_rules import counts
from tests.llm.test_secrets import expected as expected_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def bag(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    """Input and output of every stage, and what run() gives."""
    from regspan.llm.common import stored, table

    docs, out = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, sf_dir), f"test-{name}")
        out[name] = docs, after
        docs = after
    return out


def test_stages(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "secret_scan", "source_mix", "best_fit_packing",
    ]
    for name, (_, after) in list(results.items())[:-1]:
        assert after.columns == COLUMNS, name


def test_quality_rules(results):
    before, after = results["quality_rules"]
    kept = bag(after)
    assert kept <= bag(before)
    assert not any(counts(row[1])[-1] for row in kept)
    # Clean running text stays.
    dropped = bag(before) - kept
    assert all(
        counts(r[1])[-1] or sum(c in "#*$%&|<>" for c in r[1]) > 0.005 * len(r[1]) for r in dropped
    )


def test_near_dedup_links_from_80_percent(spark, docs_of, results, sf_dir):
    before, after = results["near_dedup"]
    rows = before.collect()
    kept = {i for i, (_, _, k) in brute([(r.doc_id, r.text) for r in rows], percent=80).items() if k}
    assert bag(after) == Counter(tuple(r) for r in rows if r.doc_id in kept)
    # 204 shingles: 7 words apart from each other change 35, so 169 of 239 are common; 4 change 20,
    # 184 of 224 (82 %).
    text, texts = words(208, 1), []
    for changed in (0, 4, 7):
        texts.append([f"new{changed}" if i % 20 == 10 and i < 20 * changed else w for i, w in enumerate(text)])
    docs = docs_of([" ".join(t) for t in texts])
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()} == {0, 2}
    assert {r.doc_id for r in minhash.deduplicated(docs).collect()} == {0, 1, 2}


def masked(text):
    out, at = "", 0
    for start, _, end in expected_spans(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_secret_scan(results):
    before, after = results["secret_scan"]
    assert bag(after) == Counter(
        (r.doc_id, masked(r.text), r.lang, r.source, len(masked(r.text))) for r in before.collect()
    )
    assert not any(s for r in after.collect() for s in expected_spans(r.text) if s[1] < 3)


def test_source_mix(results):
    before, after = results["source_mix"]
    times = Counter(r.doc_id for r in after.collect())
    rows = before.collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        n = size(r.text)
        sizes[r.source] += n
        taken[r.source] += n * times[r.doc_id]
        largest[r.source] = max(largest[r.source], n)
    assert max(times.values()) <= 3 and set(times) <= {r.doc_id for r in rows}
    for source, wanted in targets(sizes).items():
        assert abs(taken[source] - wanted) <= largest[source] / 2 + 1e-6


def test_best_fit_packing(results):
    before, after = results["best_fit_packing"]
    rows = after.collect()
    texts = [(r.doc_id, r.text) for r in before.collect()]
    assert Counter(tuple(r)[:5] for r in rows) == expected_pieces(texts)
    tokens = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= tokens / 4096 * 1.02 + 1


def test_run_gives_the_same(spark, sf_dir, results):
    def pieces(df):
        return Counter(tuple(r)[:5] for r in df.collect())

    assert pieces(corpus_pipeline.run(spark, sf_dir)) == pieces(results["best_fit_packing"][1])


@pytest.mark.parametrize("name", oracles.oracle_sql())
def test_queries_agree_with_sql(spark, sf_dir, name):
    sql = catalog.oracle_sql()[name]
    assert differences(catalog.queries()[name](spark, sf_dir), duckdb_on(sf_dir), sql) == []


def test_registered_names():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in catalog.queries() if n != "pipeline"} == set(range(1, 14))
