"""The dump as Parquet files, and the five steps over it."""

import warnings
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.catalog import CUTOFFS, ON_DUMP
from regspan.operators import history
from regspan.plans import pipeline
from regspan.schemas import TABLE_FILES
from regspan.sources.dump import open_dump, scan_table

FEW = CUTOFFS[::6]


@pytest.fixture(scope="module")
def stored_dir(dump, tmp_path_factory):
    base = tmp_path_factory.mktemp("dump")
    for table, file in TABLE_FILES.items():
        dump[table].write.parquet(f"{base}/{file}.parquet")
    return str(base)


@pytest.fixture
def stored(spark, stored_dir):
    return open_dump(spark, stored_dir)


def bag(df):
    return Counter(tuple(row) for row in df.select(*(f"`{c}`" for c in sorted(df.columns))).collect())


@pytest.mark.parametrize("name", ["los_leaderboard", "assign_attributes", "reporting_dataset"])
def test_queries_on_files(dump, stored, name):
    assert bag(ON_DUMP[name](stored)) == bag(ON_DUMP[name](dump))


def test_directory_from_environment(spark, stored_dir, monkeypatch):
    monkeypatch.setenv("PARQUET_DIR", stored_dir)
    assert scan_table(spark, "providers").count() == 5
    monkeypatch.delenv("PARQUET_DIR")
    with pytest.raises(ValueError):
        scan_table(spark, "providers")


def test_missing_and_wrong_columns_fail_early(spark, tmp_path):
    spark.sql("SELECT 'a' AS id").write.parquet(f"{tmp_path}/{TABLE_FILES['providers']}.parquet")
    with pytest.raises(ValueError, match="id is string, expected integer; name is missing"):
        scan_table(spark, "providers", str(tmp_path))


def test_zoned_timestamps_and_small_keys_are_accepted(spark, dump, tmp_path):
    nodes = dump["nodes"].select(
        *(F.col(c).cast("timestamp").alias(c) if t.startswith("timestamp") else F.col(c)
          for c, t in dump["nodes"].dtypes if c != "spam_status"),
        F.col("spam_status").cast("smallint"),
    )
    nodes.write.parquet(f"{tmp_path}/{TABLE_FILES['nodes']}.parquet")
    for table in ("logs", "artifacts"):
        dump[table].write.parquet(f"{tmp_path}/{TABLE_FILES[table]}.parquet")
    zoned = open_dump(spark, str(tmp_path))
    assert bag(history.event_history_panel(zoned, FEW)) == bag(
        history.event_history_panel(dump, FEW)
    )


def test_zoned_timestamps_need_a_session_in_utc(spark, dump, tmp_path):
    nodes = dump["nodes"].withColumn("created", F.col("created").cast("timestamp"))
    nodes.write.parquet(f"{tmp_path}/{TABLE_FILES['nodes']}.parquet")
    dump["logs"].write.parquet(f"{tmp_path}/{TABLE_FILES['logs']}.parquet")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="session must be in UTC"):
            scan_table(spark, "nodes", str(tmp_path))
        scan_table(spark, "logs", str(tmp_path))  # without a zone any session will do
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_all_steps(spark, stored, dump, tmp_path):
    data = str(tmp_path)
    pipeline.run_all(stored, spark, data, CUTOFFS)
    panel = spark.read.parquet(f"{data}/{pipeline.PANEL}").drop("year")
    assert bag(panel) == bag(history.event_history_panel(dump, CUTOFFS))
    report = spark.read.parquet(f"{data}/{pipeline.REPORT}")
    expected = ON_DUMP["reporting_dataset"](dump)
    assert bag(report) == bag(expected)
    annual = spark.read.parquet(f"{data}/{pipeline.ANNUAL}")
    assert bag(annual) == bag(ON_DUMP["annual_number_format"](dump))
    # The panel alone is enough for the summaries.
    before = bag(spark.read.parquet(f"{data}/{pipeline.SUMMARIES}"))
    pipeline.step_summaries(spark, data, from_panel=True)
    assert bag(spark.read.parquet(f"{data}/{pipeline.SUMMARIES}")) == before
    # A panel made by another snapshot function leaves runs behind that must not be used.
    pipeline.step_history(stored, data, FEW, snapshot=history.resource_counts_at_date)
    pipeline.step_summaries(spark, data)
    dates = spark.read.parquet(f"{data}/{pipeline.SUMMARIES}").select("date").distinct()
    assert sorted(r.date for r in dates.collect()) == FEW


def test_missing_summaries(spark, stored, tmp_path):
    data = str(tmp_path)
    pipeline.step_attributes(stored, data, names=["funded"])
    pipeline.step_history(stored, data, FEW, snapshot=history.resource_counts_at_date)
    pipeline.step_summaries(spark, data, names=["funded"])
    with pytest.raises(FileNotFoundError):
        pipeline.step_report(spark, data, ["funded"])
    pipeline.step_summaries(spark, data, names=["overall"])
    with pytest.warns(UserWarning, match="no attribute funder"):
        pipeline.step_report(spark, data, ["funded", "funder"])
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        pipeline.step_report(spark, data, ["funded"])
    report = spark.read.parquet(f"{data}/{pipeline.REPORT}")
    assert {r.attribute for r in report.select("attribute").distinct().collect()} == {
        "overall", "funded",
    }
