"""The five steps as jobs: each reads stored tables and writes one.

    1 attributes   tall bag (node_id, attribute, subgroup), one folder per attribute
    2 history      status runs with their cutoffs, and the panel, one folder per year
    3 summaries    one table, one folder per attribute
    4 report       long-form dataset, one folder per attribute
    5 annual       one folder per year
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regspan.functions.cutoffs import check_cutoffs
from regspan.operators import annual, attributes, history, reporting, summary
from regspan.operators.samples import Sample
from regspan.schemas import OVERALL, SUPPORTED_ATTRIBUTES, VALID_REGISTRATION
from regspan.sources.dump import Dump

ATTRIBUTES, RUNS, PANEL = "osr_attributes", "los_runs", "los_ts"
CUTOFFS = "los_cutoffs"  # of the stored runs; empty where the panel was made without runs
SUMMARIES, REPORT, ANNUAL = "los_ts_summary", "reporting_dataset", "annual_indicators"


def _write(df: DataFrame, path: str, *partition_cols: str) -> None:
    """Overwrite a table, or with partition columns only the partitions `df` has."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_cols).parquet(path)


def _read_attributes(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Rows of the attributes a table partitioned by attribute has; others are skipped with a
    warning. A missing overall part is an error."""
    found = []
    for name in names:
        try:
            spark.read.parquet(f"{path}/attribute={name}")
            found.append(name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            if name == OVERALL:
                raise FileNotFoundError(f"{path} has no overall summary: run step 3") from None
            warnings.warn(f"{path} has no attribute {name}: skipped", stacklevel=3)
    table = spark.read.parquet(path)
    return table.where(table["attribute"].isin(*found))


def step_attributes(
    dump: Dump,
    data_dir: str,
    sample: Sample = VALID_REGISTRATION,
    names: Sequence[str] = SUPPORTED_ATTRIBUTES,
) -> None:
    """Attributes of all registrations of the sample."""
    tall = attributes.assign_attributes(dump, sample, names)
    _write(tall, f"{data_dir}/{ATTRIBUTES}", "attribute")


def step_history(
    dump: Dump,
    data_dir: str,
    cutoffs: Sequence[date | str],
    sample: Sample = VALID_REGISTRATION,
    snapshot: Callable[[Dump, date, Sample], DataFrame] | None = None,
    null_as_zero: bool = False,
) -> None:
    """Status runs with their cutoffs, and the panel; with another snapshot function only the
    panel. Runs of an earlier call are then no longer used."""
    panel_path = f"{data_dir}/{PANEL}"
    spark = dump["nodes"].sparkSession
    # Without cutoffs there are no valid runs, whatever happens from here on.
    _write(spark.createDataFrame([], "cutoff date"), f"{data_dir}/{CUTOFFS}")
    if snapshot is not None:
        panel = history.event_history_panel(dump, cutoffs, sample, snapshot=snapshot)
        _write(panel.withColumn("year", F.year("date")), panel_path, "year")
        return
    runs_path = f"{data_dir}/{RUNS}"
    runs = history.status_runs(dump, cutoffs, sample, null_as_zero)
    _write(runs, runs_path)
    stored = spark.read.parquet(runs_path)
    panel = history.panel_of_runs(stored, cutoffs)
    _write(panel.withColumn("year", F.year("date")), panel_path, "year")
    dates = [(d,) for d in check_cutoffs(cutoffs)]
    _write(spark.createDataFrame(dates, "cutoff date").coalesce(1), f"{data_dir}/{CUTOFFS}")


def _stored_cutoffs(spark: SparkSession, data_dir: str) -> list[date]:
    rows = spark.read.schema("cutoff date").parquet(f"{data_dir}/{CUTOFFS}").orderBy("cutoff")
    return [r.cutoff for r in rows.collect()]


def step_summaries(
    spark: SparkSession,
    data_dir: str,
    names: Sequence[str] = (*SUPPORTED_ATTRIBUTES, OVERALL),
    from_panel: bool = False,
) -> None:
    """Summaries by attribute: from the status runs of step 2 and their cutoffs, or from the
    panel where there are none or `from_panel` says so."""
    bag = spark.read.parquet(f"{data_dir}/{ATTRIBUTES}")
    cutoffs = [] if from_panel else _stored_cutoffs(spark, data_dir)
    if cutoffs:
        runs = spark.read.parquet(f"{data_dir}/{RUNS}")
        table = summary.los_summary_of_runs(runs, bag, cutoffs, names)
    else:
        panel = spark.read.parquet(f"{data_dir}/{PANEL}").drop("year")
        table = summary.los_summary_all(panel, bag, names)
    _write(table, f"{data_dir}/{SUMMARIES}", "attribute")


def step_report(
    spark: SparkSession, data_dir: str, names: Sequence[str] = SUPPORTED_ATTRIBUTES
) -> None:
    """Report dataset of the overall summary and of the named attributes."""
    table = _read_attributes(spark, f"{data_dir}/{SUMMARIES}", [OVERALL, *names])
    _write(reporting.reporting_dataset(table), f"{data_dir}/{REPORT}", "attribute")


def step_annual(
    spark: SparkSession,
    data_dir: str,
    years: Sequence[int] | None = None,
    pretty_numbers: bool = True,
    fmt: str = "parquet",
) -> None:
    """Annual indicator tables."""
    report = spark.read.parquet(f"{data_dir}/{REPORT}")
    table = annual.annual_indicator_pivot(report, years)
    if pretty_numbers:
        table = annual.annual_number_format(table)
    annual.annual_report_sink(table, f"{data_dir}/{ANNUAL}", fmt)


def run_all(dump: Dump, spark: SparkSession, data_dir: str, cutoffs: Sequence[date | str]) -> None:
    """All five steps."""
    step_attributes(dump, data_dir)
    step_history(dump, data_dir, cutoffs)
    step_summaries(spark, data_dir)
    step_report(spark, data_dir)
    step_annual(spark, data_dir)
