"""Links between registrations and resources, and the status they give over time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regspan.functions.columns import is_true, mined_key, sum_if
from regspan.functions.cutoffs import (
    check_cutoffs,
    cutoff_literal,
    cutoff_position,
    cutoffs_id,
)
from regspan.functions.joins import left_join_many
from regspan.functions.timeline import by_position, next_position, running, spread, tied
from regspan.operators.samples import Sample, nodes
from regspan.schemas import OUTCOME_TYPE, OUTPUT_TYPES, RESOURCE_ADDED, VALID_REGISTRATION
from regspan.sources.dump import Dump

Cutoff = date | datetime | str

COUNT_COLUMNS = (
    "linked_outputs",
    "linked_outcomes",
    "removed_outputs",
    "removed_outcomes",
    "first_linked_output",
    "first_linked_outcome",
    "total_resources",
    "net_resources",
    "net_outputs",
    "net_outcomes",
    "is_los",
)


def _is_output() -> Column:
    return F.col("artifact_type").isin(*OUTPUT_TYPES)


def _is_outcome() -> Column:
    return F.col("artifact_type") == OUTCOME_TYPE


def _kept() -> Column:
    return F.col("artifact_deleted").isNull()


def _registrations_at(dump: Dump, sample: Sample, cutoff: Column) -> DataFrame:
    existing = (F.col("created") <= cutoff) & F.col("id").isNotNull()
    return nodes(dump, sample).where(existing)


def _additions(dump: Dump, cutoff: Column) -> DataFrame:
    """Log rows up to the cutoff that add a resource, with the artifact id they name."""
    return (
        dump["logs"]
        .where((F.col("action") == RESOURCE_ADDED) & (F.col("created") <= cutoff))
        .where(F.col("node_id").isNotNull())
        .select(
            "node_id",
            F.col("created").alias("added"),
            mined_key("params").alias("artifact_id"),
        )
    )


def _artifacts(dump: Dump, created_by: Column, alive_at: Column) -> DataFrame:
    """Final artifacts created by one cutoff and not yet deleted at another."""
    deleted = F.col("deleted")
    return (
        dump["artifacts"]
        .where(F.col("finalized") & (F.col("created") <= created_by))
        .where(deleted.isNull() | (deleted > alive_at))
        .select(
            F.col("_id").alias("artifact_id"),
            "artifact_type",
            F.col("created").alias("artifact_created"),
            F.col("deleted").alias("artifact_deleted"),
        )
    )


def resource_history(
    dump: Dump, cutoff: Cutoff, sample: Sample = VALID_REGISTRATION
) -> DataFrame:
    """Registrations at a cutoff with the resources added by then: one row per log row.

    Log rows without an artifact visible at the cutoff, and registrations without log rows,
    keep NULLs.
    """
    at = cutoff_literal(cutoff)
    registrations = _registrations_at(dump, sample, at).select(F.col("id").alias("node_id"))
    # The log is on the left here, so an id named by very many log rows can be split.
    added = _additions(dump, at).drop("added").join(_artifacts(dump, at, at), "artifact_id", "left")
    return left_join_many(registrations, added, "node_id").select(
        "node_id", "artifact_id", "artifact_type", "artifact_created", "artifact_deleted"
    )


def _of_sample(additions: DataFrame, registrations: DataFrame, small_sample: bool) -> DataFrame:
    """Log rows, for a small sample only those of its registrations.

    Most log rows belong to some valid registration, and looking that up would cost one more
    shuffle of the log than it saves; for a small sample it spares nearly all of the work.
    """
    if not small_sample:
        return additions
    return additions.join(registrations.select("node_id"), "node_id", "left_semi")


def _with_totals(counts: DataFrame, null_as_zero: bool) -> DataFrame:
    """Totals and LOS flag from the four counts.

    Registrations without a visible artifact have NULL linked counts, hence NULL totals and
    flag, and 0 removed ones.
    """
    zero = ["removed_outputs", "removed_outcomes"]
    if null_as_zero:
        zero += ["linked_outputs", "linked_outcomes"]
    counts = counts.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})
    linked = F.col("linked_outputs") + F.col("linked_outcomes")
    removed = F.col("removed_outputs") + F.col("removed_outcomes")
    net_outputs = F.col("linked_outputs") - F.col("removed_outputs")
    net_outcomes = F.col("linked_outcomes") - F.col("removed_outcomes")
    return counts.withColumns(
        {
            "total_resources": linked,
            "net_resources": linked - removed,
            "net_outputs": net_outputs,
            "net_outcomes": net_outcomes,
            "is_los": ((net_outputs > 0) & (net_outcomes > 0)).cast("int"),
        }
    )


def resource_counts_at_date(
    dump: Dump,
    cutoff: Cutoff,
    sample: Sample = VALID_REGISTRATION,
    null_as_zero: bool = False,
    small_sample: bool = False,
) -> DataFrame:
    """Linked, removed and net resources of every registration at a cutoff, with LOS status.

    "Removed" are artifacts still visible at the cutoff and deleted later. Links are summed
    per registration before they meet the registrations, so that join is one to one.
    """
    at = cutoff_literal(cutoff)
    registrations = _registrations_at(dump, sample, at).select(F.col("id").alias("node_id"))
    added = _of_sample(_additions(dump, at), registrations, small_sample)
    links = added.join(_artifacts(dump, at, at), "artifact_id")
    counts = links.groupBy("node_id").agg(
        sum_if(_is_output() & _kept()).alias("linked_outputs"),
        sum_if(_is_outcome() & _kept()).alias("linked_outcomes"),
        sum_if(_is_output() & ~_kept()).alias("removed_outputs"),
        sum_if(_is_outcome() & ~_kept()).alias("removed_outcomes"),
        F.min(F.when(_is_output() & _kept(), F.col("artifact_created"))).alias(
            "first_linked_output"
        ),
        F.min(F.when(_is_outcome() & _kept(), F.col("artifact_created"))).alias(
            "first_linked_outcome"
        ),
    )
    joined = registrations.join(counts, "node_id", "left")
    return _with_totals(joined, null_as_zero).select("node_id", *COUNT_COLUMNS)


_RUNNING = (
    "born",
    "known",
    "linked_outputs",
    "linked_outcomes",
    "removed_outputs",
    "removed_outcomes",
)
_FIRSTS = ("first_linked_output", "first_linked_outcome")


def _link_changes(dump: Dump, additions: DataFrame, cutoffs: Sequence[date]) -> DataFrame:
    """Changes of the counts of a node: each link once where it becomes visible and once,
    negated, where its artifact is gone."""
    last = cutoff_literal(cutoffs[-1])
    n = len(cutoffs)
    # Positions are taken before the join: it then moves and compares small integers.
    additions = additions.select(
        "node_id", "artifact_id", cutoff_position("added", cutoffs).alias("added_at")
    )
    artifacts = _artifacts(dump, last, cutoff_literal(cutoffs[0])).select(
        "*",
        cutoff_position("artifact_created", cutoffs).alias("created_at"),
        cutoff_position("artifact_deleted", cutoffs).alias("stop"),
    )
    start = F.greatest("added_at", "created_at")
    links = additions.join(artifacts, "artifact_id").where(start < F.col("stop"))
    begin = F.struct(start.alias("position"), F.lit(1).alias("sign"))
    end = F.struct(F.col("stop").alias("position"), F.lit(-1).alias("sign"))
    both_ends = F.when(F.col("stop") < n, F.array(begin, end)).otherwise(F.array(begin))
    changes = links.select(
        "node_id", "artifact_type", "artifact_created", "artifact_deleted", F.inline(both_ends)
    )
    first = _kept() & (F.col("sign") > 0)
    return changes.select(
        "node_id",
        "position",
        F.lit(0).alias("born"),
        # A status is known as soon as one artifact of a known type is visible.
        (is_true(F.col("artifact_type").isNotNull() | ~_kept()) * F.col("sign")).alias("known"),
        (is_true(_is_output() & _kept()) * F.col("sign")).alias("linked_outputs"),
        (is_true(_is_outcome() & _kept()) * F.col("sign")).alias("linked_outcomes"),
        (is_true(_is_output() & ~_kept()) * F.col("sign")).alias("removed_outputs"),
        (is_true(_is_outcome() & ~_kept()) * F.col("sign")).alias("removed_outcomes"),
        # Never-deleted artifacts stay, so their running minimum is exact.
        F.when(_is_output() & first, F.col("artifact_created")).alias("first_linked_output"),
        F.when(_is_outcome() & first, F.col("artifact_created")).alias("first_linked_outcome"),
    )


def status_runs(
    dump: Dump,
    cutoffs: Sequence[Cutoff],
    sample: Sample = VALID_REGISTRATION,
    null_as_zero: bool = False,
    small_sample: bool = False,
) -> DataFrame:
    """Status of every registration as runs of cutoffs with equal counts.

    One scan and one join for all cutoffs. Log rows, artifacts and registrations become
    changes, added up per (node, cutoff position) on the map side first; running totals per
    node then give the state from one change to the next. Nothing here grows with
    registrations x cutoffs, and a node has at most one row per cutoff however many links
    it has. `cutoffs_id` marks the cutoffs that positions refer to.
    """
    cutoffs = check_cutoffs(cutoffs)
    last = cutoff_literal(cutoffs[-1])
    births = _registrations_at(dump, sample, last).select(
        F.col("id").alias("node_id"),
        cutoff_position("created", cutoffs).alias("position"),
        F.lit(1).alias("born"),
    )
    added = _of_sample(_additions(dump, last), births, small_sample)
    changes = _link_changes(dump, added, cutoffs).unionByName(births, allowMissingColumns=True)
    per_position = changes.groupBy("node_id", "position").agg(
        *(F.sum(c).alias(c) for c in _RUNNING), *(F.min(c).alias(c) for c in _FIRSTS)
    )
    keys = ["node_id"]
    totals = per_position.select(
        "node_id",
        "position",
        next_position(keys, len(cutoffs)).alias("next_position"),
        *(F.coalesce(running(F.sum(c), keys), F.lit(0)).alias(c) for c in _RUNNING),
        *(running(F.min(c), keys).alias(c) for c in _FIRSTS),
    )
    # Links may be older than the registration, and nodes outside the sample have links too:
    # both are dropped here, after they have been counted.
    known = F.col("known") > 0
    alive = totals.where(F.col("born") > 0).withColumns(
        {c: F.when(known, F.col(c)) for c in ("linked_outputs", "linked_outcomes")}
    )
    states = _with_totals(alive.drop("born", "known"), null_as_zero)
    return states.withColumns(
        {
            "los_lag": F.lag("is_los").over(by_position(keys)),
            "cutoffs_id": F.lit(cutoffs_id(cutoffs)),
        }
    )


def _los_change(before: Column) -> Column:
    """1 on a gain, -1 on a loss, else 0; an unknown status is neither."""
    now = F.col("is_los")
    return (
        F.when((now == 1) & (before.isNull() | (before == 0)), 1)
        .when((now == 0) & (before == 1), -1)
        .otherwise(0)
    )


def panel_of_runs(runs: DataFrame, cutoffs: Sequence[Cutoff]) -> DataFrame:
    """The panel: one row per registration and cutoff, with the change of LOS status.

    The cutoffs must be those of the runs.
    """
    cutoffs = check_cutoffs(cutoffs)
    dense = spread(tied(runs, cutoffs), cutoffs)
    before = F.when(F.col("offset") > 0, F.col("is_los")).otherwise(F.col("los_lag"))
    return dense.select(
        "date",
        "node_id",
        *COUNT_COLUMNS,
        before.alias("los_lag"),
        _los_change(before).alias("los_change"),
    )


def event_history_panel(
    dump: Dump,
    cutoffs: Sequence[Cutoff],
    sample: Sample = VALID_REGISTRATION,
    null_as_zero: bool = False,
    small_sample: bool = False,
    snapshot: Callable[[Dump, date, Sample], DataFrame] | None = None,
    measures: Sequence | None = None,
    status: Callable[[dict[str, Column]], Column] | None = None,
) -> DataFrame:
    """Counts and LOS status of every registration at every cutoff it existed at.

    The counts of `resource_counts_at_date` are computed for all cutoffs in one pass. So are
    `measures` the caller names (`regspan.operators.measures.Measure`: sums, counts, distinct
    counts, minima and maxima of links that may end), with is_los from `status` over them.
    Any other `snapshot(dump, cutoff, sample)` that returns `node_id` and `is_los` is called
    per cutoff and stacked.
    """
    if measures is not None:
        from regspan.operators.measures import measure_panel

        return measure_panel(dump, cutoffs, measures, sample, small_sample, status)
    if snapshot is None:
        runs = status_runs(dump, cutoffs, sample, null_as_zero, small_sample)
        return panel_of_runs(runs, cutoffs)
    taken = [
        snapshot(dump, cutoff, sample).withColumn("date", F.lit(cutoff))
        for cutoff in check_cutoffs(cutoffs)
    ]
    # A node has one row per cutoff.
    in_time = Window.partitionBy("node_id").orderBy("date")
    return (
        reduce(DataFrame.unionByName, taken)
        .withColumn("los_lag", F.lag("is_los").over(in_time))
        .withColumn("los_change", _los_change(F.col("los_lag")))
    )
