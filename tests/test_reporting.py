from datetime import date

import pytest
from pyspark.sql import functions as F

from regspan.operators import annual, reporting

SUMMARY = "funded string, date date, n_osr long, prop_los double, other long"
JAN, FEB, MAR = date(2020, 1, 1), date(2020, 2, 1), date(2020, 3, 1)


@pytest.fixture
def lines(spark):
    rows = [("yes", JAN, 0, 0.5, 1), ("yes", FEB, 4, 0.25, 1), ("yes", MAR, 5, 0.5, 1),
            ("no", FEB, 7, 0.0, 1), (None, JAN, 1, 1.0, 1), (None, FEB, 2, 1.0, 1)]
    return spark.createDataFrame(rows, SUMMARY)


def moments(df, *keys):
    return {tuple(r[k] for k in keys): r.value for r in df.collect()}


def test_moments(lines):
    long = reporting.summary_longform(lines, "funded")
    assert long.count() == lines.count() * 3 * 4
    got = moments(long, "funded", "date", "metric", "moment")
    assert got[("yes", JAN, "n_osr", "lag")] is None
    assert got[("yes", FEB, "n_osr", "delta")] == 4
    assert got[("yes", FEB, "n_osr", "growth")] is None  # from zero
    assert got[("yes", MAR, "n_osr", "growth")] == 0.25
    assert got[("yes", MAR, "prop_los", "growth")] == 1.0
    assert got[("no", FEB, "n_osr", "lag")] is None
    assert got[(None, FEB, "n_osr", "growth")] == 1.0


def test_longform_without_groups(lines):
    overall = lines.where("funded = 'yes'").drop("funded")
    got = moments(reporting.summary_longform(overall), "date", "metric", "moment")
    assert got[(MAR, "n_osr", "delta")] == 1


def test_value_types(spark):
    names = ["n_osr", "are_los", "have_outputs", "prop_los", "xn_osr", "proportion", "n_n_osr"]
    df = spark.createDataFrame([(n,) for n in names], "metric string")
    got = {(r.metric, r.value_type) for r in reporting.value_types(df).collect()}
    assert got == {("osr", "count"), ("los", "count"), ("outputs", "count"),
                   ("los", "proportion"), ("n_osr", "count")}


REPORT = "attribute string, subgroup string, date date, metric string, moment string, value double, value_type string"


def report_rows(spark, rows):
    return spark.createDataFrame(rows, REPORT)


def test_annual_table_is_whole(spark):
    report = report_rows(
        spark,
        [
            ("overall", None, date(2020, 2, 1), "osr", "value", 10.0, "count"),
            ("overall", None, date(2020, 2, 15), "osr", "value", 12.0, "count"),
            ("overall", None, date(2021, 3, 1), "los", "growth", 0.5, "proportion"),
            ("overall", None, date(2021, 3, 1), "resources", "value", 1.0, "count"),
            ("funder", "A", date(2022, 3, 1), "osr", "value", 1.0, "count"),
        ],
    )
    table = annual.annual_indicator_pivot(report)
    rows = {(r.year, r.section, r.line): r for r in table.collect()}
    assert len(rows) == 2 * 3 * 5
    # The last date of a month counts.
    assert rows[(2020, "TOTALS", 1)]["2"] == 12.0
    assert rows[(2020, "TOTALS", 1)]["indicator"] == "Open Registrations"
    assert rows[(2021, "% GROWTH", 5)]["3"] == 0.5
    assert rows[(2021, "TOTALS", 1)]["3"] is None
    assert annual.annual_indicator_pivot(report, years=[2021]).count() == 15
    by_subgroup = annual.annual_indicator_pivot(report, by_subgroup=True)
    assert by_subgroup.where("attribute = 'funder' AND subgroup = 'A' AND year = 2022").count() == 15
    assert by_subgroup.count() == 45
    # the report is read once: no copy of it for the lines without values
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert sum("LogicalRDD" in line or "LocalRelation" in line for line in plan.splitlines()) == 1
    assert "Union" not in plan


def formatted(spark, section, line, value, month=7, **options):
    columns = ["year int", "section string", "line int", "indicator string"]
    columns += [f"`{m}` double" for m in annual.MONTHS]
    row = (2020, section, line, "x", *[value if m == str(month) else None for m in annual.MONTHS])
    df = spark.createDataFrame([row], ", ".join(columns))
    return annual.annual_number_format(df, **options).first()[str(month)]


@pytest.mark.parametrize(
    ("section", "line", "value", "modern", "legacy"),
    [
        ("TOTALS", 1, 1234567.0, "1,234,567", "1,234,567"),
        ("TOTALS", 1, 2.5, "2", "2"),
        ("TOTALS", 5, 0.00125, "0.12", "0.12"),  # an exact tie goes to even
        ("TOTALS", 5, 0.02675, "2.67", "2.67"),  # 2.675 lies below the tie
        ("TOTALS", 5, 7.0, "700.00", "7"),
        ("NET CHANGE", 4, -3.0, "-3", "-3"),
        ("NET CHANGE", 5, -0.00001, "-0.00", "-0.00"),
        ("% GROWTH", 1, 0.05, "5.00", "0"),
        ("% GROWTH", 1, -0.3, "-30.00", "0"),
        ("% GROWTH", 5, 0.05, "5.00", "5.00"),
        ("TOTALS", 1, None, None, None),
    ],
)
def test_number_format(spark, section, line, value, modern, legacy):
    assert formatted(spark, section, line, value) == modern
    assert formatted(spark, section, line, value, legacy_format=True) == legacy


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_annual_sink_replaces_only_its_years(spark, tmp_path, fmt):
    def tables(value):
        return annual.annual_indicator_pivot(
            report_rows(
                spark,
                [
                    ("overall", None, date(year, 1, 1), "osr", "value", value, "count")
                    for year in (2020, 2021)
                ],
            )
        )

    path = str(tmp_path / "annual")
    annual.annual_report_sink(tables(1.0), path, fmt)
    annual.annual_report_sink(tables(2.0).where("year = 2021"), path, fmt)
    reader = spark.read.option("header", True).option("inferSchema", True)
    stored = reader.format(fmt).load(path)
    assert stored.count() == 30
    first = stored.where("line = 1 AND section = 'TOTALS'")
    assert {(r.year, r["1"]) for r in first.collect()} == {(2020, 1.0), (2021, 2.0)}
    with pytest.raises(ValueError):
        annual.annual_report_sink(tables(1.0), path, "xlsx")


def test_report_questions_use_the_latest_date_of_the_report(spark):
    report = report_rows(
        spark,
        [
            ("overall", None, JAN, "los", "value", 1.0, "count"),
            ("overall", None, FEB, "los", "value", 2.0, "count"),
            ("overall", None, FEB, "los", "growth", 1.0, "count"),
            ("institution", "A", FEB, "los", "value", 0.1, "proportion"),
            ("institution", "B", FEB, "los", "value", 0.9, "proportion"),
            ("institution", "C", JAN, "los", "value", 0.9, "proportion"),
        ],
    )
    assert reporting.report_los_today(report).where(F.col("date") != FEB).count() == 0
    assert reporting.report_los_today(report).count() == 2
    shares = reporting.report_los_share_by_institution(report).collect()
    assert [r.subgroup for r in shares] == ["B", "A"]
    assert [r.value for r in reporting.report_growth_series(report).collect()] == [1.0]
