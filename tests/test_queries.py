"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from checks import catalog, oracles
from checks.compare import differences, duckdb_on
from checks.fixtures import fixture_dump
from regspan.schemas import TABLE_FILES

QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duckdb_on(sf_dir), ORACLES[name]) == []


def test_entry_runs(spark):
    assert contract.entry(spark).columns == ["institution", "n_regs", "n_los", "prop_los"]


def test_queries_start_no_job(spark, sf_dir):
    dump = fixture_dump(spark, sf_dir)
    for table in TABLE_FILES:  # opening a table reads its footer
        dump[table].count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("laziness", "building queries", False)
    try:
        for name in ("resource_history", "event_history_panel", "los_summary_all"):
            catalog.ON_DUMP[name](dump)
        assert len(tracker.getJobIdsForGroup("laziness")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
