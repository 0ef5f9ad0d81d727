import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from regspan.functions.cutoffs import cutoff_dates
from regspan.operators import attributes, history, summary
from regspan.operators.history import (
    COUNT_COLUMNS,
    event_history_panel,
    resource_counts_at_date,
    resource_history,
)
from tests.handmade import added, artifact, make_dump, node

MONTHS = cutoff_dates("2020-01-01", "2020-12-01")


def bag(df, *columns):
    columns = columns or sorted(df.columns)
    return Counter(tuple(row) for row in df.select(*columns).collect())


def per_cutoff(dump, cutoffs, **options):
    """The panel by its definition: one snapshot per cutoff."""
    return event_history_panel(
        dump,
        cutoffs,
        snapshot=lambda d, cutoff, sample: resource_counts_at_date(d, cutoff, sample, **options),
    )


@pytest.fixture
def stories(spark):
    """Registration 1 gains and loses; 2 has a repeated log row; 3 has no links; 4 is younger
    than its link; 5 is loss through NULL; 6 names artifacts in odd ways."""
    return make_dump(
        spark,
        nodes=[
            node(1), node(2), node(3), node(4, "2020-06-15"), node(5), node(6),
            node(7, is_public=False),
        ],
        logs=[
            added(1, "5aaaaa", "2020-01-10"), added(1, "5bbbbb", "2020-02-10"),
            added(2, "5aaaaa", "2020-01-10"), added(2, "5aaaaa", "2020-01-10"),
            added(2, "5aaaaa", "2020-03-10"), added(2, "5ccccc", "2020-01-10", "node_updated"),
            added(4, "5aaaaa", "2020-01-10"),
            added(5, "5ddddd", "2020-01-10"), added(5, "5eeeee", "2020-01-10"),
            added(6, "xx5aaaaa", "2020-01-10"), added(6, None, "2020-01-10"),
            added(6, "nothing", "2020-01-10"), added(6, "5nofin", "2020-01-10"),
            added(7, "5aaaaa", "2020-01-10"),
        ],
        artifacts=[
            artifact("5aaaaa", 1, "2020-01-09"),
            artifact("5bbbbb", 31, "2020-02-20", "2020-05-01"),
            artifact("5ccccc", 31, "2020-01-01"),
            artifact("5ddddd", 11, "2020-01-01", "2020-06-10"),
            artifact("5eeeee", 31, "2020-01-01", "2020-06-10"),
            artifact("5nofin", 31, "2020-01-01", None, False),
        ],
    )


def test_history_keeps_rows_without_artifact(stories):
    got = bag(resource_history(stories, "2020-04-01"), "node_id", "artifact_id", "artifact_type")
    assert got == Counter(
        {
            (1, "5aaaaa", 1): 1, (1, "5bbbbb", 31): 1, (2, "5aaaaa", 1): 3, (3, None, None): 1,
            (5, "5ddddd", 11): 1, (5, "5eeeee", 31): 1,
            (6, "5aaaaa", 1): 1, (6, None, None): 1, (6, "", None): 1, (6, "5nofin", None): 1,
        }
    )


def test_history_is_lazy_and_takes_predicates(stories):
    only = resource_history(stories, "2020-04-01", sample=[F.col("id") == 2])
    assert {row.node_id for row in only.collect()} == {2}


def test_counts_at_date(stories):
    rows = {r.node_id: r for r in resource_counts_at_date(stories, "2020-04-01").collect()}
    assert set(rows) == {1, 2, 3, 5, 6}
    one = rows[1]
    assert (one.linked_outputs, one.linked_outcomes) == (1, 0)
    # Alive at the cutoff and deleted later: counted as removed, so the net count is negative.
    assert (one.removed_outcomes, one.net_outcomes, one.is_los) == (1, -1, 0)
    assert rows[2].linked_outputs == 3
    assert (rows[3].linked_outputs, rows[3].removed_outputs, rows[3].is_los) == (None, 0, None)
    assert one.first_linked_output == datetime(2020, 1, 9)
    zero = {r.node_id: r for r in resource_counts_at_date(stories, "2020-04-01",
                                                          null_as_zero=True).collect()}
    assert (zero[3].linked_outputs, zero[3].net_resources, zero[3].is_los) == (0, 0, 0)


def test_deleted_artifacts_vanish(stories):
    rows = {r.node_id: r for r in resource_counts_at_date(stories, "2020-05-01").collect()}
    assert (rows[1].removed_outcomes, rows[1].net_outcomes) == (0, 0)


@pytest.mark.parametrize("null_as_zero", [False, True])
def test_panel_is_the_snapshots(stories, null_as_zero):
    one_pass = event_history_panel(stories, MONTHS, null_as_zero=null_as_zero)
    assert bag(one_pass) == bag(per_cutoff(stories, MONTHS, null_as_zero=null_as_zero))


def los_dump(spark):
    """LOS from February; the outcome goes in May, everything in August."""
    return make_dump(
        spark,
        nodes=[node(1)],
        logs=[added(1, "5aaaaa", "2020-01-10"), added(1, "5bbbbb", "2020-01-10"),
              added(1, "5ccccc", "2020-04-10")],
        artifacts=[artifact("5aaaaa", 1, "2020-01-01"), artifact("5bbbbb", 31, "2020-01-01"),
                   artifact("5ccccc", 31, "2020-04-01", "2020-05-15")],
    )


def test_gain_and_loss(spark):
    panel = event_history_panel(los_dump(spark), MONTHS).orderBy("date").collect()
    changes = {r.date: r.los_change for r in panel if r.los_change}
    # The outcome deleted in May counts as removed while it is there.
    assert changes == {
        date(2020, 2, 1): 1, date(2020, 5, 1): -1, date(2020, 6, 1): 1,
    }
    assert [r.los_lag for r in panel][:3] == [None, None, 1]


def test_loss_into_null_is_missed_unless_null_is_zero(spark):
    """A registration cannot lose its status into NULL through live links, since a link that
    is deleted later counts as removed; a snapshot function of one's own can."""
    status = {MONTHS[0]: 1, MONTHS[1]: None, MONTHS[2]: 1, MONTHS[3]: 0}

    def snapshot(dump, cutoff, sample):
        return dump["nodes"].select(
            F.col("id").alias("node_id"), F.lit(status[cutoff]).cast("int").alias("is_los")
        )

    dump = make_dump(spark, nodes=[node(1)])
    panel = event_history_panel(dump, MONTHS[:4], snapshot=snapshot).orderBy("date").collect()
    assert [r.los_change for r in panel] == [1, 0, 1, -1]


def brute_force(nodes, logs, artifacts, cutoffs):
    """The panel in plain Python."""
    rows = Counter()
    for cutoff in cutoffs:
        at = datetime(cutoff.year, cutoff.month, cutoff.day)
        for n in nodes:
            if n[2] > at:
                continue
            counts, firsts, seen = [0, 0, 0, 0], [None, None], False
            for log in logs:
                if log[0] != n[0] or log[2] > at:
                    continue
                for key, kind, created, deleted, final in artifacts:
                    if key not in log[3] or not final or created > at:
                        continue
                    if deleted is not None and deleted <= at:
                        continue
                    seen = True
                    which = 0 if kind in (1, 11, 21, 41) else 1 if kind == 31 else None
                    if which is None:
                        continue
                    counts[which + (2 if deleted else 0)] += 1
                    if not deleted:
                        firsts[which] = min(firsts[which] or created, created)
            lo, lc, ro, rc = counts
            known = (lo, lc, lo + lc, lo + lc - ro - rc, lo - ro, lc - rc,
                     int(lo - ro > 0 and lc - rc > 0)) if seen else (None,) * 7
            rows[(cutoff, n[0], known[0], known[1], ro, rc, *firsts, *known[2:])] += 1
    return rows


def test_panel_against_brute_force_with_a_hot_registration_and_artifact(spark):
    rng = random.Random(7)
    start = datetime(2020, 1, 1)

    def moment(days):
        return (start + timedelta(days=rng.randrange(-30, days), hours=rng.randrange(24))).isoformat()

    nodes = [node(i, moment(300)) for i in range(12)]
    artifacts = []
    for i in range(40):
        created = moment(330)
        gone = datetime.fromisoformat(created) + timedelta(days=rng.randrange(1, 200))
        artifacts.append(
            artifact(f"5{i:05d}", rng.choice([1, 11, 21, 41, 31, 31, 99]), created,
                     gone.isoformat() if rng.random() < 0.4 else None, rng.random() < 0.9)
        )
    # A third of the log rows is about one registration and one artifact.
    logs = [added(0, "500000", moment(330)) for _ in range(100)] + [
        added(rng.randrange(12), f"5{rng.randrange(40):05d}", moment(330)) for _ in range(200)
    ]
    dump = make_dump(spark, nodes=nodes, logs=logs, artifacts=artifacts)
    panel = event_history_panel(dump, MONTHS)
    assert bag(panel, "date", "node_id", *COUNT_COLUMNS) == brute_force(
        nodes, logs, artifacts, MONTHS
    )
    assert bag(panel) == bag(per_cutoff(dump, MONTHS))


def test_single_cutoff(stories):
    panel = event_history_panel(stories, ["2020-04-01"])
    counts = resource_counts_at_date(stories, "2020-04-01")
    assert bag(panel.drop("date", "los_lag", "los_change")) == bag(counts)
    assert {r.los_lag for r in panel.collect()} == {None}


def test_small_sample_changes_nothing_but_the_way(stories):
    sample = [F.col("id").isin(1, 3, 5)]
    panel = event_history_panel(stories, MONTHS, sample)
    assert bag(panel) == bag(event_history_panel(stories, MONTHS, sample, small_sample=True))
    counts = resource_counts_at_date(stories, "2020-04-01", sample)
    small = resource_counts_at_date(stories, "2020-04-01", sample, small_sample=True)
    assert bag(counts) == bag(small)
    assert counts.count() == 3


def test_panel_rows_are_the_registrations_alive(dump):
    cutoffs = cutoff_dates("1999-01-01", "1999-12-01")
    panel = event_history_panel(dump, cutoffs)
    created = [r.created for r in dump_valid(dump)]
    expected = sum(c <= datetime(m.year, m.month, m.day) for c in created for m in cutoffs)
    assert panel.count() == expected


def dump_valid(dump):
    from regspan.operators.samples import valid_registrations

    return valid_registrations(dump).select("created").collect()


def test_runs_are_tied_to_their_cutoffs(dump):
    months = cutoff_dates("1999-01-01", "1999-12-01")
    runs = history.status_runs(dump, months)
    for other in (months[3:], months[:-1], cutoff_dates("2000-01-01", "2000-12-01")):
        with pytest.raises(SparkRuntimeException, match="other cutoffs"):
            history.panel_of_runs(runs, other).collect()
    bag = attributes.assign_attributes(dump, attributes=["provider"])
    with pytest.raises(SparkRuntimeException, match="other cutoffs"):
        summary.los_summary_of_runs(runs, bag, months[1:], ["provider"]).collect()


def test_times_of_day_make_a_panel_of_instants(dump):
    noon = datetime(2000, 3, 15, 12)
    panel = event_history_panel(dump, ["2000-01-01", noon])
    assert dict(panel.dtypes)["date"] == "timestamp_ntz"
    assert bag(panel) == bag(per_cutoff(dump, ["2000-01-01", noon]))
    midnight = event_history_panel(dump, [datetime(2000, 1, 1), "2000-02-01"])
    assert dict(midnight.dtypes)["date"] == "date"
    assert midnight.count() == event_history_panel(dump, ["2000-01-01", "2000-02-01"]).count()


def test_an_hourly_panel_is_the_snapshots(spark):
    """Cutoffs every 5 hours; log rows, artifacts and deletions at all hours of the day."""
    rng = random.Random(5)
    start = datetime(2020, 1, 1)

    def moment(hours):
        return (start + timedelta(hours=rng.randrange(-20, hours), minutes=rng.randrange(60))).isoformat()

    nodes = [node(i, moment(60)) for i in range(8)]
    artifacts = []
    for i in range(25):
        created = moment(70)
        gone = datetime.fromisoformat(created) + timedelta(hours=rng.randrange(1, 40))
        artifacts.append(artifact(f"5{i:05d}", rng.choice([1, 11, 31, 31, 99]), created,
                                  gone.isoformat() if rng.random() < 0.5 else None))
    logs = [added(rng.randrange(8), f"5{rng.randrange(25):05d}", moment(70)) for _ in range(120)]
    dump = make_dump(spark, nodes=nodes, logs=logs, artifacts=artifacts)
    hours = cutoff_dates("2020-01-01 03:00", "2020-01-04 03:00", "5 hours")
    assert len(hours) == 15 and hours[1] == datetime(2020, 1, 1, 8)
    for null_as_zero in (False, True):
        panel = event_history_panel(dump, hours, null_as_zero=null_as_zero)
        assert bag(panel) == bag(per_cutoff(dump, hours, null_as_zero=null_as_zero))


def test_positions_of_instants_by_binary_search(spark):
    from bisect import bisect_left

    from regspan.functions.cutoffs import check_cutoffs, cutoff_position

    rng = random.Random(3)
    for n in (1, 2, 7, 64, 100):
        base = datetime(2020, 1, 1, 1)
        cutoffs = check_cutoffs(sorted({base + timedelta(minutes=rng.randrange(10_000)) for _ in range(n)}))
        moments = [base + timedelta(minutes=rng.randrange(-100, 10_100)) for _ in range(200)]
        moments += list(cutoffs) + [None]
        df = spark.createDataFrame([(m,) for m in moments], "m timestamp_ntz")
        found = [r.p for r in df.select(cutoff_position("m", cutoffs).alias("p")).collect()]
        assert found == [len(cutoffs) if m is None else bisect_left(cutoffs, m) for m in moments]