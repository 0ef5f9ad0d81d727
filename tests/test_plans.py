"""Plans as they would be on large tables: nothing broadcast, hot keys split."""

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from checks.catalog import ON_DUMP
from checks.fixtures import fixture_dump
from regspan.functions.joins import left_join_many
from regspan.operators import attributes, history
from regspan.schemas import TABLE_FILES
from regspan.sources.dump import open_dump

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bag(df):
    return Counter(tuple(row) for row in df.select(*(f"`{c}`" for c in sorted(df.columns))).collect())


@pytest.mark.parametrize(
    "name",
    ["reg_funder", "resource_history", "resource_counts_at_date", "event_history_panel",
     "los_summary_all", "los_leaderboard"],
)
def test_same_result_without_broadcasts(spark, sf_dir, name):
    expected = bag(ON_DUMP[name](fixture_dump(spark, sf_dir)))
    with settings(spark, NO_BROADCAST):
        shuffled = ON_DUMP[name](fixture_dump(spark, sf_dir))
        text = plan(shuffled)
        assert "Broadcast" not in text
        assert "CartesianProduct" not in text
        assert "SinglePartition" not in text
        assert bag(shuffled) == expected


@pytest.fixture
def few_large(spark):
    """One row per key on the left; one key holds most rows of the right."""
    one = spark.range(100).select(F.col("id").alias("node_id"))
    many = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("node_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
    )
    return one, many


def test_hot_key_on_the_right_is_split(spark, few_large):
    one, many = few_large
    split = {
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    with settings(spark, split):
        joined = left_join_many(one, many, "node_id")
        rows = Counter(tuple(row) for row in joined.collect())
        assert "skew=true" in plan(joined)  # final once collected
        plain = one.join(many, "node_id", "left")
        assert rows == Counter(tuple(row) for row in plain.collect())
        assert "skew=true" not in plan(plain)


def test_tasks_of_a_join_with_many_rows_do_not_hold_all_of_them(spark, few_large):
    """Matches need no sort of the many rows; the keys of the rest are not merged into few tasks."""
    one, many = few_large
    with settings(spark, NO_BROADCAST):
        joined = left_join_many(one, many, "node_id")
        joined.collect()
        matched, rest = plan(joined).split("Initial Plan")[0].split("LeftAnti")
        assert "ShuffledHashJoin" in matched and "Sort" not in matched.split("ShuffledHashJoin")[1].split("Project")[0]
        assert "REPARTITION_BY_NUM" in rest and "coalesced" not in rest


def test_attribute_rows_are_counted_before_they_meet_the_registrations(spark, dump):
    """A hot registration then has no more rows than there are values, in each of these."""
    with settings(spark, {**NO_BROADCAST, "spark.sql.adaptive.enabled": "false"}):
        for name in ("los_leaderboard", "los_summary_by_attribute_institution"):
            text = plan(ON_DUMP[name](dump))
            assert "LeftAnti" not in text
            assert "partial_count(1)" in text
        text = plan(attributes.assign_attributes(dump, attributes=["funder", "funded"], weights=True))
        assert text.count("funding_info") and text.count("from_json") <= 2


def test_weights_equal_counted_bags(spark, dump):
    names = ["institution", "funder", "subject", "subject_parent", "provider"]
    plain = attributes.assign_attributes(dump, attributes=names)
    counted = attributes.assign_attributes(dump, attributes=names, weights=True)
    keys = ["node_id", "attribute", "subgroup"]
    expected = plain.groupBy(*keys).agg(F.count("*").alias("weight"))
    assert bag(counted.groupBy(*keys).agg(F.sum("weight").alias("weight"))) == bag(expected)


def test_overall_reports_read_three_tables_only(spark, dump):
    with settings(spark, {**NO_BROADCAST, "spark.sql.adaptive.enabled": "false"}):
        for name in ("report_los_today", "report_growth_series"):
            assert plan(ON_DUMP[name](dump)).count("FileScan parquet") == 3, name
        text = plan(ON_DUMP["report_los_share_by_institution"](dump))
        assert "funding_info" not in text and "l_suppkey" not in text
        for name in ("annual_indicator_pivot", "summary_longform", "latest_snapshot"):
            assert "Exchange rangepartitioning" not in plan(ON_DUMP[name](dump)), name


def test_filters_and_columns_reach_the_scan(spark, dump, tmp_path):
    for table in ("nodes", "logs", "artifacts"):
        dump[table].write.parquet(f"{tmp_path}/{TABLE_FILES[table]}.parquet")
    stored = open_dump(spark, str(tmp_path))
    with settings(spark, {"spark.sql.maxMetadataStringLength": "1000"}):
        text = plan(history.resource_counts_at_date(stored, "2001-12-01"))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    schemas = {line.split("ReadSchema: ")[1] for line in scans}
    assert "struct<node_id:bigint,action:string,created:timestamp_ntz,params:string>" in schemas
    assert not any("registered_meta" in s or "creator_id" in s for s in schemas)
    log = next(line for line in scans if "params" in line)
    assert "EqualTo(action,resource_identifier_added)" in log
    assert "LessThanOrEqual(created,2001-12-01T00:00)" in log


def test_panel_needs_no_shuffle_after_the_status_runs(spark, dump):
    with settings(spark, {**NO_BROADCAST, "spark.sql.adaptive.enabled": "false"}):
        cutoffs = ["2000-01-01", "2000-02-01"]
        runs = plan(history.status_runs(dump, cutoffs))
        panel = plan(history.event_history_panel(dump, cutoffs))
    assert panel.count("Exchange hashpartitioning") == runs.count("Exchange hashpartitioning")
    # One scan of each table for any number of cutoffs.
    assert panel.count("FileScan parquet") == 3


def test_attributes_share_their_joins(spark, dump):
    with settings(spark, {**NO_BROADCAST, "spark.sql.adaptive.enabled": "false"}):
        both = plan(attributes.assign_attributes(dump, attributes=["funder", "funded"]))
        single = plan(attributes.assign_attributes(dump, attributes=["funder"]))
    assert both.count("SortMergeJoin") == single.count("SortMergeJoin")
