from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from regspan.functions.cutoffs import (
    check_cutoffs,
    cutoff_dates,
    cutoff_literal,
    cutoff_position,
    cutoff_sequence,
)
from regspan.operators.samples import nodes, sample_filter, valid_registrations
from tests.handmade import make_dump, node


@pytest.mark.parametrize(
    ("start", "end", "step"),
    [
        ("2023-01-01", "2024-03-15", "month"),
        ("2023-01-31", "2023-12-31", "month"),
        ("2023-01-30", "2024-03-01", "month"),
        ("2020-02-29", "2024-03-01", "year"),
        ("2023-01-01", "2023-02-01", "day"),
        ("2023-01-01", "2023-02-01", "2 weeks"),
        ("2023-01-01", "2024-12-31", "quarter"),
        ("2023-01-01", "2023-01-01", "month"),
        ("2023-01-02", "2023-01-01", "month"),
        ("2023-01-02", "2023-01-01", "day"),
    ],
)
def test_cutoffs_agree_in_python_and_spark(spark, start, end, step):
    series = cutoff_sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), step)
    in_spark = spark.range(1).select(F.explode(series)).collect()
    assert [row[0] for row in in_spark] == cutoff_dates(start, end, step)


def test_cutoffs_of_late_days_run_over():
    assert cutoff_dates("2023-01-31", "2023-05-31")[:3] == [
        date(2023, 1, 31), date(2023, 3, 3), date(2023, 3, 31),
    ]


def test_end_is_included_only_on_a_step():
    assert cutoff_dates("2023-01-01", "2023-03-01")[-1] == date(2023, 3, 1)
    assert cutoff_dates("2023-01-02", "2023-03-01")[-1] == date(2023, 2, 2)


def test_bad_steps_and_cutoffs():
    for step in ("fortnight", "0 days", "month 2"):
        with pytest.raises(ValueError):
            cutoff_dates("2023-01-01", "2023-02-01", step)
    for cutoffs in ([], ["2023-02-01", "2023-01-01"], ["2023-01-01", "2023-01-01"]):
        with pytest.raises(ValueError):
            check_cutoffs(cutoffs)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_cutoff_position_is_first_cutoff_at_or_after(spark, kind):
    cutoffs = [date(2023, 1, 1), date(2023, 1, 15), date(2023, 3, 1)]
    moments = [
        "2022-12-31 23:59:59", "2023-01-01 00:00:00", "2023-01-01 00:00:00.000001",
        "2023-01-14 12:00:00", "2023-01-15 00:00:00", "2023-02-28 23:59:59.999999",
        "2023-03-01 00:00:00", "2023-03-01 00:00:00.000001", "2030-01-01 00:00:00", None,
    ]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(moments)], "i int, m string")
    got = df.select("i", cutoff_position(F.col("m").cast(kind), cutoffs)).orderBy("i").collect()

    def expected(moment):
        if moment is None:
            return len(cutoffs)
        seen = datetime.fromisoformat(moment)
        return sum(datetime(c.year, c.month, c.day) < seen for c in cutoffs)

    assert [row[1] for row in got] == [expected(m) for m in moments]


def test_cutoff_literal_accepts_text_dates_and_datetimes(spark):
    values = ["2023-01-01", date(2023, 1, 1), datetime(2023, 1, 1), "2023-01-01 12:30:00"]
    row = spark.range(1).select(*(cutoff_literal(v).cast("string") for v in values)).first()
    assert [str(v)[:10] for v in row] == ["2023-01-01"] * 4
    assert row[3] == "2023-01-01 12:30:00"


def test_validity_is_three_valued(spark):
    dump = make_dump(
        spark,
        nodes=[
            node(1),
            node(2, spam_status=2),
            node(3, spam_status=1),
            node(4, is_public=None),
            node(5, registered_date=None),
            node(6, moderation_state="pending"),
            node(7, deleted=datetime(2021, 1, 1)),
            node(8, type="osf.node"),
        ],
    )
    assert {row.id for row in valid_registrations(dump).collect()} == {1, 3}


def test_sample_mixes_text_and_columns(spark):
    dump = make_dump(spark, nodes=[node(1), node(2, creator_id=5), node(3, creator_id=5)])
    kept = nodes(dump, ["creator_id = 5", F.col("id") > 2])
    assert [row.id for row in kept.collect()] == [3]
    assert sample_filter(dump["nodes"], None).count() == 3
