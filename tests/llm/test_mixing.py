import re

import pytest
from pyspark.sql import functions as F

from regspan.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what is above the limit is shared anew by the others."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        rest = [s for s in names if s not in fixed]
        if not rest:
            return fixed
        left = sum(sizes.values()) - sum(fixed.values())
        level = left / sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * level > most * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in rest}
        fixed |= {s: most * sizes[s] for s in over}


def check(docs):
    rows = mixing.mix(docs).collect()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        source = r.row.source
        assert r.size == size(r.row.text) and 0 <= r.copies <= 3
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.size * r.copies
        largest[source] = max(largest.get(source, 0), r.size)
    wanted = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.row.source]
        assert r.target == pytest.approx(wanted[r.row.source])
    for source, n in taken.items():
        assert abs(n - wanted[source]) <= largest[source] / 2 + 1e-6
    return {(r.row.doc_id, r.row.text): r.copies for r in rows}


def test_given_table(given):
    assert check(given) == check(given.repartition(5))


def test_limits_nulls_and_order_of_sources(docs_of):
    rows = [(i, "w " * (i % 17), s) for i, s in enumerate(["a", "Z", "é", None, ""] * 40)]
    rows += [(1000 + i, "word " * 50, "hot") for i in range(300)]
    rows += [(2000, None, "only null"), (2001, "one two", "tiny")]
    check(docs_of(rows))


def test_nested_thresholds(given):
    few = {r.row.doc_id: r.copies for r in mixing.mix(given, (1, 1), 3).collect()}
    assert set(few.values()) <= {0, 1, 2, 3}


def test_mixture_repeats_rows(given):
    copies = mixing.mix(given).agg(F.sum("copies")).first()[0]
    mixed = mixing.mixed(given)
    assert mixed.columns == given.columns and mixed.count() == copies


def test_no_python_in_the_plan(given):
    plan = mixing.mix(given)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_odd_rows(odd, clashing, empty):
    assert len(mixing.mix(odd).collect()) == odd.count()
    assert mixing.mixed(clashing).columns == clashing.columns
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd.withColumn("text", F.lit(None).cast("string"))).agg(F.max("copies")).first()[0] <= 3
