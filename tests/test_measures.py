"""The one-pass panel of named measures against one snapshot per cutoff."""

import random
from collections import Counter
from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regspan.functions.cutoffs import cutoff_dates
from regspan.operators.history import event_history_panel
from regspan.operators.measures import Measure, measure_panel, measure_snapshot
from tests.handmade import added, artifact, make_dump, node

MONTHS = cutoff_dates("2020-01-01", "2020-12-01")


def measures():
    output = F.col("artifact_type").isin(1, 11, 21, 41)
    return [
        Measure("live_outputs", "count", where=output & F.col("artifact_deleted").isNull()),
        Measure("types", "distinct", "artifact_type"),
        Measure("first_visible", "min", "artifact_created"),  # expires when that artifact goes
        Measure("latest_visible", "max", "artifact_created"),
        Measure("type_sum", "sum", F.col("artifact_type")),
        Measure("first_output", "min", "artifact_created", where=output),
    ]


def status(m):
    return (m["live_outputs"] > 0) & (m["types"] > 1)


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def per_cutoff(dump, cutoffs, measures, **options):
    return event_history_panel(
        dump, cutoffs,
        snapshot=lambda d, c, s: measure_snapshot(d, c, measures, s, **options).withColumn(
            "is_los", status({m.name: F.col(m.name) for m in measures}).cast("int")
        ),
    )


@pytest.fixture(scope="module")
def hot_dump(spark):
    """A third of the log rows about one registration; links that end, repeat and restart."""
    rng = random.Random(11)
    start = datetime(2020, 1, 1)

    def moment(days):
        return (start + timedelta(days=rng.randrange(-30, days), hours=rng.randrange(24))).isoformat()

    nodes = [node(i, moment(300)) for i in range(12)] + [node(20, "2021-03-01")]
    artifacts = []
    for i in range(40):
        created = moment(330)
        gone = datetime.fromisoformat(created) + timedelta(days=rng.randrange(1, 200))
        artifacts.append(
            artifact(f"5{i:05d}", rng.choice([1, 11, 21, 41, 31, 31, 99, None]), created,
                     gone.isoformat() if rng.random() < 0.5 else None, rng.random() < 0.9)
        )
    logs = [added(0, f"5{rng.randrange(5):05d}", moment(330)) for _ in range(150)] + [
        added(rng.randrange(12), f"5{rng.randrange(40):05d}", moment(330)) for _ in range(300)
    ]
    return make_dump(spark, nodes=nodes, logs=logs, artifacts=artifacts)


@pytest.mark.parametrize("cutoffs", [MONTHS, MONTHS[:1], MONTHS[::5]])
def test_panel_is_the_snapshots(hot_dump, cutoffs):
    panel = measure_panel(hot_dump, cutoffs, measures(), status=status)
    expected = per_cutoff(hot_dump, cutoffs, measures())
    assert bag(panel) == bag(expected)


def test_small_sample_and_no_additive_measure(hot_dump):
    only = [m for m in measures() if m.kind in ("min", "max")]
    panel = measure_panel(hot_dump, MONTHS, only, small_sample=True)
    stacked = reduce(DataFrame.unionByName, [
        measure_snapshot(hot_dump, c, only, small_sample=True).withColumn("date", F.lit(c)) for c in MONTHS
    ])
    assert bag(panel) == bag(stacked)


def test_one_scan_whatever_the_cutoffs(hot_dump):
    def scans(cutoffs):
        plan = measure_panel(hot_dump, cutoffs, measures())._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("LogicalRDD") + plan.count("LocalRelation")

    assert scans(MONTHS[:3]) == scans(MONTHS)


def test_refuses_unknown_kinds():
    with pytest.raises(ValueError):
        Measure("x", "median", "artifact_created")
    with pytest.raises(ValueError):
        Measure("x", "min")


def test_links_are_read_twice_whatever_the_measures(spark, dump):
    """One pass for changes and one for blocks; the panel's rows meet no join."""
    panel = measure_panel(dump, MONTHS, measures()[:4], status=status)
    plan = panel._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 4  # log and artifacts, twice each
    assert "Join" not in plan[: plan.index("RepartitionByExpression")]


def test_registrations_of_one_id_and_panel_without_additive_measures(spark):
    """Rows of equal id keep a row each; a panel of minima alone needs no changes."""
    nodes = [node(1, "2020-02-10"), node(1, "2020-04-10"), node(2, "2020-03-01")]
    artifacts = [artifact("500001", 1, "2020-01-05", "2020-06-05"), artifact("500002", 31, "2020-05-05", None)]
    logs = [added(1, "500001", "2020-01-06"), added(1, "500002", "2020-05-06"), added(3, "500001", "2020-01-06")]
    dump = make_dump(spark, nodes=nodes, logs=logs, artifacts=artifacts)
    least = [Measure("first_visible", "min", "artifact_created")]
    found = measure_panel(dump, MONTHS, least).groupBy("node_id", "date").count()
    assert {r["node_id"]: r["sum(count)"] for r in found.groupBy("node_id").sum("count").collect()} == {1: 18, 2: 10}
    by_date = {r["date"].month: r["first_visible"] for r in measure_panel(dump, MONTHS, least).where("node_id = 1").collect()}
    assert [by_date[m] and by_date[m].month for m in range(3, 13)] == [1, 1, 1, 1, 5, 5, 5, 5, 5, 5]
