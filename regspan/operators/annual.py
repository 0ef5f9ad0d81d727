"""Annual indicator tables: months as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspan.schemas import OVERALL, REPORTING_LABELS, SECTION_LABELS

# Lines of every section: metric, value type, label.
_LINES = (
    ("osr", "count", REPORTING_LABELS["n_osr"]),
    ("outputs", "count", REPORTING_LABELS["have_outputs"]),
    ("outcomes", "count", REPORTING_LABELS["have_outcomes"]),
    ("los", "count", REPORTING_LABELS["are_los"]),
    ("los", "proportion", REPORTING_LABELS["prop_los"]),
)
MONTHS = tuple(str(m) for m in range(1, 13))
_SHARE_LINE = 5


def _line() -> Column:
    """Number of the line a report row belongs to, NULL if none."""
    line = F.lit(None).cast("int")
    for number, (metric, value_type, _) in enumerate(_LINES, 1):
        is_line = (F.col("metric") == metric) & (F.col("value_type") == value_type)
        line = F.when(is_line, number).otherwise(line)
    return line


def _section() -> Column:
    section = F.lit(None).cast("string")
    for moment, label in SECTION_LABELS.items():
        section = F.when(F.col("moment") == moment, label).otherwise(section)
    return section


def _skeleton() -> Column:
    """All (section, line) of a table."""
    return F.array(
        *(
            F.struct(F.lit(label).alias("section"), F.lit(number).alias("line"))
            for label in SECTION_LABELS.values()
            for number in range(1, len(_LINES) + 1)
        )
    )


def annual_indicator_pivot(
    report: DataFrame, years: Sequence[int] | None = None, by_subgroup: bool = False
) -> DataFrame:
    """Per year three sections (totals, net change, growth) of five indicators by month.

    A month shows the value of its last date; every table has all its lines. With
    `by_subgroup` there is a table for each attribute and subgroup, not just overall.
    """
    keys = ["attribute", "subgroup", "year"] if by_subgroup else ["year"]
    rows = report.withColumn("year", F.year("date"))
    if not by_subgroup:
        rows = rows.where(F.col("attribute") == OVERALL)
    if years is not None:
        rows = rows.where(F.col("year").isin(*years))
    known = (F.col("section").isNotNull() & F.col("line").isNotNull()).alias("known")
    cell = F.struct("section", "line", "month", "date", "value")
    # One group per table holds its cells (a table has at most a few lines a day of a year), so
    # that tables without values still get every line and the report is read once.
    tables = (
        rows.select(*keys, _section().alias("section"), _line().alias("line"),
                    F.month("date").alias("month"), "date", "value")
        .groupBy(*keys)
        .agg(F.collect_list(F.when(known, cell)).alias("cells"))
        .select(*keys, "cells", F.inline(_skeleton()))
    )

    def latest(month: int) -> Column:
        """The value of the line's last date in the month (NULL if none)."""
        mine = F.filter(
            "cells",
            lambda c: (c["section"] == F.col("section")) & (c["line"] == F.col("line"))
            & (c["month"] == month),
        )
        return F.array_max(F.transform(mine, lambda c: F.struct(c["date"], c["value"])))["value"]

    labels = F.array(*(F.lit(label) for _, _, label in _LINES))
    return tables.select(
        *keys,
        "section",
        "line",
        F.get(labels, F.col("line") - 1).alias("indicator"),
        *(latest(int(m)).alias(m) for m in MONTHS),
    )


def _as_percentage(value: Column) -> Column:
    """Percentage with two decimals, rounded by the exact binary value, ties to even."""
    return F.call_function("format_number", value * 100, F.lit("0.00"))


def _as_count(value: Column) -> Column:
    """Whole number with thousands separators, ties to even."""
    # Adding zero turns a negative zero into a plain one.
    return F.format_number(F.rint(value) + F.lit(0.0), 0)


def annual_number_format(annual: DataFrame, legacy_format: bool = False) -> DataFrame:
    """Month columns as text: counts with separators, shares and growth as percentages.

    `legacy_format` treats growth of counts as a count ("0" for 5 %) and leaves a number
    below 13 unformatted in the month it is equal to.
    """
    percentage = F.col("line") == _SHARE_LINE
    if not legacy_format:
        percentage = percentage | (F.col("section") == SECTION_LABELS["growth"])

    def text(month: str) -> Column:
        value = F.col(month)
        formatted = F.when(percentage, _as_percentage(value)).otherwise(_as_count(value))
        if legacy_format:
            formatted = F.when(value == int(month), F.lit(month)).otherwise(formatted)
        return F.when(value.isNotNull(), formatted).alias(month)

    others = [c for c in annual.columns if c not in MONTHS]
    return annual.select(*others, *(text(m) for m in MONTHS))


def annual_report_sink(annual: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write one folder per year. Years present are replaced, other years stay."""
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt must be 'parquet' or 'csv'")
    writer = (
        annual.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
    )
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
