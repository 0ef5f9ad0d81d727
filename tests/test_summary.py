from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks.catalog import CUTOFFS
from regspan.functions.totals import with_total
from regspan.operators import attributes, history, summary
from regspan.schemas import OVERALL, SUPPORTED_ATTRIBUTES, VALID_REGISTRATION

PANEL = "node_id long, date date, net_resources long, net_outputs long, net_outcomes long, is_los int"
JAN, FEB = date(2020, 1, 1), date(2020, 2, 1)


@pytest.fixture
def panel(spark):
    rows = [
        (1, JAN, 2, 1, 1, 1), (1, FEB, 0, -1, 1, 0),
        (2, JAN, None, None, None, None), (2, FEB, 1, 1, 0, 0),
        (3, FEB, 3, 2, 1, 1),
    ]
    return spark.createDataFrame(rows, PANEL)


def bag(df):
    return Counter(tuple(row) for row in df.select(*sorted(df.columns)).collect())


def test_nulls_count_as_zero(panel):
    rows = {r.date: r for r in summary.los_summary_by_attribute(panel).collect()}
    assert (rows[JAN].n_osr, rows[JAN].have_outputs, rows[JAN].are_los) == (2, 1, 1)
    assert rows[JAN].prop_los == 0.5
    assert rows[FEB].prop_osr == 3 / 5


def test_share_within_dates(panel):
    rows = summary.los_summary_by_attribute(panel, share_within=["date"]).collect()
    assert {r.prop_osr for r in rows} == {1.0}


def test_bag_rows_count_again_and_missing_ones_under_null(spark, panel):
    memberships = spark.createDataFrame(
        [(1, "A"), (1, "A"), (1, "B"), (2, None)], "node_id long, institution string"
    )
    got = summary.los_summary_by_attribute(panel, "institution", memberships)
    n = {(r.institution, r.date): (r.n_osr, r.are_los) for r in got.collect()}
    assert n == {
        ("A", JAN): (2, 2), ("A", FEB): (2, 0), ("B", JAN): (1, 1), ("B", FEB): (1, 0),
        (None, JAN): (1, 0), (None, FEB): (2, 1),
    }


@pytest.mark.parametrize("names", [("funder",), ("funder", "subject", OVERALL), (OVERALL,)])
def test_all_at_once_equals_one_by_one(spark, panel, names):
    rows = [(1, "funder", "A"), (1, "funder", "A"), (1, "funder", None), (2, "subject", "S"),
            (3, "subject", "S"), (3, "subject", "T"), (1, "subject", "T")]
    tall = spark.createDataFrame(rows, "node_id long, attribute string, subgroup string")
    expected = Counter()
    for name in names:
        one = tall.where(F.col("attribute") == name).select("node_id", F.col("subgroup").alias(name))
        lines = summary.los_summary_by_attribute(panel, name, one)
        if name == OVERALL:
            lines = lines.withColumn(OVERALL, F.lit(None).cast("string"))
        lines = lines.withColumnRenamed(name, "subgroup").withColumn("attribute", F.lit(name))
        expected += bag(lines)
    assert bag(summary.los_summary_all(panel, tall, names)) == expected


def test_runs_and_panel_give_the_same_summary(dump):
    runs = history.status_runs(dump, CUTOFFS)
    tall = attributes.assign_attributes(dump, VALID_REGISTRATION)
    dense = history.panel_of_runs(runs, CUTOFFS)
    names = ("institution", "template", "subject_parent", OVERALL)
    assert bag(summary.los_summary_of_runs(runs, tall, CUTOFFS, names)) == bag(
        summary.los_summary_all(dense, tall, names)
    )


def test_summary_invariants(dump):
    runs = history.status_runs(dump, CUTOFFS)
    tall = attributes.assign_attributes(dump, VALID_REGISTRATION)
    shares, sizes = defaultdict(float), defaultdict(Counter)
    for row in summary.los_summary_of_runs(runs, tall, CUTOFFS).collect():
        shares[row.attribute] += row.prop_osr
        sizes[row.attribute][row.date] += row.n_osr
    assert set(shares) == {*SUPPORTED_ATTRIBUTES, OVERALL}
    for attribute, share in shares.items():
        assert share == pytest.approx(1)
        assert all(sizes[attribute][d] >= n for d, n in sizes[OVERALL].items())


def test_summarizer_threshold_and_order(panel):
    got = summary.los_summarizer(panel, "node_id", threshold=0.3)
    assert got.columns[:3] == ["node_id", "n_osr", "prop_los"]
    assert [(r.node_id, r.prop_los) for r in got.collect()] == [(1, 0.5), (2, 0.0)]
    ungrouped = summary.los_summarizer(panel).collect()
    assert [(r.n_osr, r.prop_osr) for r in ungrouped] == [(5, 1.0)]


@pytest.mark.parametrize("threshold", [-0.1, 1.5, "0.5", None, True])
def test_bad_thresholds(panel, threshold):
    with pytest.raises(ValueError):
        summary.los_summarizer(panel, "date", threshold=threshold)


def test_bad_attributes(panel):
    for names in ((), "funder", ("colour",)):
        with pytest.raises(ValueError):
            summary.los_summary_all(panel, panel, names)
    with pytest.raises(ValueError):
        summary.los_summary_by_attribute(panel, "funder")


def test_totals_with_a_hot_group(spark):
    lines = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("group"), F.col("id").alias("n"),
        F.col("id").cast("string").alias("name"),
    )
    got = with_total(lines, "n", ["group"])
    sums = {r.group: r.total for r in got.select("group", "total").distinct().collect()}
    assert sums == {
        "hot": sum(i for i in range(3000) if i % 3), None: sum(i for i in range(3000) if i % 3 == 0)
    }
    assert bag(got.drop("total")) == bag(lines)


def test_latest_snapshot(panel):
    latest = summary.latest_snapshot(summary.los_summary_by_attribute(panel)).collect()
    assert [(r.n_osr, r.are_los) for r in latest] == [(3, 1)]


def test_leaderboard_counts_registrations_outside_the_snapshot(spark):
    memberships = spark.createDataFrame(
        [(1, "A"), (2, "A"), (3, "B")], "node_id long, institution string"
    )
    counts = spark.createDataFrame([(1, 1), (3, None)], "node_id long, is_los int")
    got = summary.los_leaderboard(memberships, counts, "institution").collect()
    assert [(r.institution, r.n_regs, r.n_los, r.prop_los) for r in got] == [
        ("A", 2, 1, 0.5), ("B", 1, 0, 0.0),
    ]


def test_partitions_of_the_summary_are_not_merged(spark, dump):
    """What meets the panel by registration keeps the given number of partitions."""
    from checks.catalog import ON_DUMP

    lines = ON_DUMP["los_summary_all_from_panel"](dump)
    assert "REPARTITION_BY_NUM" in lines._jdf.queryExecution().executedPlan().toString()
