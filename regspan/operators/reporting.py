"""Long-form reporting dataset and the questions asked of it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regspan.schemas import OVERALL

MOMENTS = ("value", "lag", "delta", "growth")


def summary_longform(summary: DataFrame, *group_cols: str) -> DataFrame:
    """One row per measure, date and moment.

    Moments are the value, the previous value of the same measure and groups, the difference,
    and the difference relative to the previous value (NULL if that is 0 or missing). All
    columns but `date` and the groups are measures.
    """
    measures = [c for c in summary.columns if c not in ("date", *group_cols)]
    ids = [*group_cols, "date"]
    long = summary.select(
        *ids, *(F.col(c).cast("double").alias(c) for c in measures)
    ).unpivot(ids, measures, "metric", "value")
    # One row per cutoff in each window partition.
    in_time = Window.partitionBy("metric", *group_cols).orderBy("date")
    moments = (
        long.withColumn("lag", F.lag("value").over(in_time))
        .withColumn("delta", F.col("value") - F.col("lag"))
        .withColumn("growth", F.try_divide("delta", "lag"))
    )
    return moments.unpivot([*ids, "metric"], list(MOMENTS), "moment", "value")


def value_types(longform: DataFrame) -> DataFrame:
    """Tell counts from proportions by the prefix of the metric and strip it.

    Metrics with neither kind of prefix are dropped.
    """
    counts, shares = "^(n_|are_|have_)", "^prop_"
    kind = F.when(F.col("metric").rlike(counts), "count").when(
        F.col("metric").rlike(shares), "proportion"
    )
    bare = F.regexp_replace("metric", f"{counts}|{shares}", "")
    typed = longform.withColumn("value_type", kind).withColumn("metric", bare)
    return typed.where(F.col("value_type").isNotNull())


def reporting_dataset(summary_all: DataFrame) -> DataFrame:
    """The report dataset from the summaries of all attributes in one table."""
    return value_types(summary_longform(summary_all, "attribute", "subgroup")).select(
        "attribute", "subgroup", "date", "metric", "moment", "value", "value_type"
    )


def _at_latest_date(report: DataFrame, latest: date | None) -> DataFrame:
    """Rows of the latest date; looked for in the report unless it is known."""
    found = F.lit(latest) if latest else report.select(F.max("date")).scalar()
    return report.where(F.col("date") == found)


def report_los_today(report: DataFrame, latest: date | None = None) -> DataFrame:
    """Overall LOS lines at the latest date. A report of the overall lines is enough."""
    return _at_latest_date(report, latest).where(
        (F.col("attribute") == OVERALL) & (F.col("metric") == "los")
    )


def report_los_share_by_institution(report: DataFrame, latest: date | None = None) -> DataFrame:
    """LOS share per institution at the latest date, largest first. A report of the
    institutions is enough."""
    return (
        _at_latest_date(report, latest)
        .where(
            (F.col("attribute") == "institution")
            & (F.col("metric") == "los")
            & (F.col("value_type") == "proportion")
            & (F.col("moment") == "value")
        )
        .orderBy(F.desc("value"))
    )


def report_growth_series(report: DataFrame) -> DataFrame:
    """Growth of the number of LOS registrations from cutoff to cutoff."""
    return report.where(
        (F.col("attribute") == OVERALL)
        & (F.col("metric") == "los")
        & (F.col("value_type") == "count")
        & (F.col("moment") == "growth")
    ).orderBy("date")
