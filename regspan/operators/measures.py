"""A panel of measures that the caller names, for all cutoffs in one pass over the log.

A link (a log row that adds a resource, met with its final artifact) is visible from the
cutoff at which both exist to the cutoff at which the artifact is gone: an interval of cutoff
positions [start, stop). A measure aggregates an expression over the links visible at a cutoff:

* `sum` and `count` change by +value where a link starts and -value where it stops; running
  totals per registration give every cutoff.
* `distinct` counts the values that at least one visible link holds: per (registration,
  value) the links' changes are added up; the value counts from where that sum turns positive
  to where it falls back to 0, which is again a change of +1 and -1.
* `min` and `max` of links that may stop: every interval is cut into at most two blocks per
  level of a dyadic partition of the positions; a block keeps the least (greatest) value of the
  links that cover it whole. The value at a cutoff is the least (greatest) over the blocks that
  hold it, one per level at most.

The first shuffles are keyed by registration and position, value or block, and rows are
combined on the map side first, so a registration with a large share of the links is no single
task. What is left of a registration are some rows per cutoff; they are shuffled once by
registration, spread over the cutoffs and added up there, so the rows of the panel are not
shuffled. The log and the artifacts are read for all cutoffs at once; a cutoff costs no scan.

A registration has a row at every cutoff from the one at which it exists. Measures are NULL
(sum, count, distinct: 0) where no link of theirs is visible. `measure_snapshot` gives one
cutoff by the definition, for tests and for single dates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regspan.functions.cutoffs import check_cutoffs, cutoff_array, cutoff_literal, cutoff_position
from regspan.operators.history import _additions, _artifacts, _of_sample, _registrations_at
from regspan.operators.samples import Sample
from regspan.schemas import VALID_REGISTRATION
from regspan.sources.dump import Dump

# Partitions of the rows that are spread over the cutoffs, as a multiple of shuffle partitions.
SPREAD = 4
KINDS = ("sum", "count", "distinct", "min", "max")
# Columns of a link that measures may use.
LINK_COLUMNS = ("node_id", "artifact_id", "artifact_type", "artifact_created", "artifact_deleted")


@dataclass(frozen=True)
class Measure:
    """`kind` of `value` over the visible links for which `where` holds (all if None)."""

    name: str
    kind: str
    value: Column | str | None = None
    where: Column | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"kind {self.kind!r} is none of {KINDS}")
        if self.value is None and self.kind != "count":
            raise ValueError(f"a {self.kind} needs a value")

    def _value(self) -> Column:
        value = F.lit(1) if self.kind == "count" else self.value
        value = F.col(value) if isinstance(value, str) else value
        return value if self.where is None else F.when(self.where, value)


def _links_at(
    dump: Dump, cutoff: Column, sample: Sample, small_sample: bool
) -> tuple[DataFrame, DataFrame]:
    registrations = _registrations_at(dump, sample, cutoff).select(F.col("id").alias("node_id"))
    added = _of_sample(_additions(dump, cutoff), registrations, small_sample)
    links = added.join(_artifacts(dump, cutoff, cutoff), "artifact_id")
    return registrations, links.select(*LINK_COLUMNS)


def measure_snapshot(
    dump: Dump, cutoff, measures: Sequence[Measure], sample: Sample = VALID_REGISTRATION,
    small_sample: bool = False,
) -> DataFrame:
    """The measures of every registration at one cutoff, by their definition."""
    registrations, links = _links_at(dump, cutoff_literal(cutoff), sample, small_sample)
    aggregate = {
        "sum": F.sum, "count": F.sum, "min": F.min, "max": F.max,
        "distinct": lambda c: F.count_distinct(c),
    }
    values = links.groupBy("node_id").agg(*(aggregate[m.kind](m._value()).alias(m.name) for m in measures))
    zero = [m.name for m in measures if m.kind in ("sum", "count", "distinct")]
    return registrations.join(values, "node_id", "left").select(
        "node_id", *(F.coalesce(m.name, F.lit(0)) if m.name in zero else F.col(m.name) for m in measures)
    ).toDF("node_id", *(m.name for m in measures))


def _intervals(dump: Dump, cutoffs: list[date], sample: Sample, small_sample: bool) -> tuple:
    """Registrations with the position where they exist, and links with [start, stop)."""
    last = cutoff_literal(cutoffs[-1])
    births = _registrations_at(dump, sample, last).select(
        F.col("id").alias("node_id"), cutoff_position("created", cutoffs).alias("birth")
    )
    added = _of_sample(_additions(dump, last), births, small_sample).select(
        "node_id", "artifact_id", cutoff_position("added", cutoffs).alias("added_at")
    )
    artifacts = _artifacts(dump, last, cutoff_literal(cutoffs[0])).select(
        "*",
        cutoff_position("artifact_created", cutoffs).alias("created_at"),
        cutoff_position("artifact_deleted", cutoffs).alias("stop"),
    )
    start = F.greatest("added_at", "created_at")
    links = (
        added.join(artifacts, "artifact_id")
        .select(*LINK_COLUMNS, start.alias("start"), "stop")
        .where(F.col("start") < F.col("stop"))
    )
    return births, links


def _both_ends(n: int) -> Column:
    """A link as +1 where it starts and -1 where it stops, if that is before the end."""
    begin = F.struct(F.col("start").alias("position"), F.lit(1).alias("sign"))
    end = F.struct(F.col("stop").alias("position"), F.lit(-1).alias("sign"))
    return F.when(F.col("stop") < n, F.array(begin, end)).otherwise(F.array(begin))


def _changes(links: DataFrame, measures: Sequence[Measure], n: int) -> DataFrame | None:
    """(node_id, position, one column per sum, count and distinct measure) of changes.

    Added up on the map side, not yet over the whole: a position may have several rows. The
    links are read once for all sums and counts and the first distinct measure.
    """
    additive = [m for m in measures if m.kind in ("sum", "count")]
    distinct = [m for m in measures if m.kind == "distinct"]
    parts = []
    for i in range(max(len(distinct), min(len(additive), 1))):
        m, added = distinct[i] if distinct else None, additive if i == 0 else []
        ends = links.select(
            *(a._value().alias(a.name) for a in added), *([m._value().alias("v")] if m else []),
            "node_id", F.inline(_both_ends(n)),
        )
        if m and not added:
            ends = ends.where(F.col("v").isNotNull())
        # coverage of each (registration, value): the sum of its links' changes
        keys = ["node_id", "v"] if m else ["node_id"]
        part = ends.groupBy(*keys, "position").agg(
            F.sum("sign").alias("sign"), *(F.sum(F.col(a.name) * F.col("sign")).alias(a.name) for a in added)
        )
        if m:
            in_value = Window.partitionBy("node_id", "v").orderBy("position")
            level = F.sum("sign").over(in_value.rowsBetween(Window.unboundedPreceding, 0))
            before = F.coalesce(F.when(F.lag("level").over(in_value) > 0, 1).otherwise(0), F.lit(0))
            turned = F.when(F.col("level") > 0, 1).otherwise(0) - before
            part = part.withColumn("level", level).withColumn(
                m.name, F.when(F.col("v").isNotNull(), turned).otherwise(0)
            )
            if not added:
                part = part.where(F.col(m.name) != 0)
        parts.append(part.drop("v", "sign", "level"))
    if not parts:
        return None
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _blocks(links: DataFrame, measures: Sequence[Measure], levels: int) -> DataFrame:
    """(node_id, position, end, a column per measure): the least or greatest value covering each
    dyadic block [position, end) of positions.

    At a level k a block i is the positions [i * 2**k, (i + 1) * 2**k). An interval [a, b) is
    the union of the blocks it covers whole whose parent it does not cover: at most the first
    and the last of each level. One pass over the links serves all measures.
    """
    size = F.expr("shiftleft(1L, level)")
    first = F.expr("CAST(ceil(start / power(2, level)) AS BIGINT)")
    last = F.expr("CAST(floor(stop / power(2, level)) AS BIGINT) - 1")

    def whole(i: Column, width: Column) -> Column:
        return (i * width >= F.col("start")) & ((i + 1) * width <= F.col("stop"))

    def canonical(i: Column) -> Column:
        parent = F.floor(i / 2)
        return whole(i, size) & ~whole(parent, size * 2)

    names = [m.name for m in measures]
    with_levels = links.select(
        "node_id", "start", "stop", *(m._value().alias(m.name) for m in measures),
        F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"),
    ).where(F.coalesce(*(F.when(F.col(c).isNotNull(), True) for c in names)))
    ends = with_levels.select(
        "node_id", "level", *names, "start", "stop", F.explode(F.array_distinct(F.array(first, last))).alias("block")
    ).where(canonical(F.col("block")))
    best = ends.groupBy("node_id", "level", "block").agg(
        *((F.min if m.kind == "min" else F.max)(m.name).alias(m.name) for m in measures)
    )
    return best.select(
        "node_id", (F.col("block") * size).cast("int").alias("position"),
        ((F.col("block") + 1) * size).cast("int").alias("end"), *names,
    )


def measure_panel(
    dump: Dump,
    cutoffs: Sequence,
    measures: Sequence[Measure],
    sample: Sample = VALID_REGISTRATION,
    small_sample: bool = False,
    status: Callable[[dict[str, Column]], Column] | None = None,
) -> DataFrame:
    """date, node_id and the measures of every registration at every cutoff it exists at.

    With `status` (measure columns by name -> 0/1 column), also is_los, los_lag, los_change.
    """
    cutoffs = check_cutoffs(cutoffs)
    n = len(cutoffs)
    levels = max(0, (n - 1).bit_length())
    births, links = _intervals(dump, cutoffs, sample, small_sample)
    names = [m.name for m in measures]
    add = [m.name for m in measures if m.kind in ("sum", "count", "distinct")]
    extreme = [m for m in measures if m.kind in ("min", "max")]
    # Each a row of few columns for a span of positions: births last to the end, changes hold
    # for their position (running totals carry them on), blocks for the positions they cover.
    # A registration has no more of them than some per cutoff, however many links it has.
    spans = births.where(F.col("birth") < n).select(
        "node_id", F.col("birth").alias("position"), F.lit(n).alias("end"), F.lit(1).alias("born")
    )
    changes = _changes(links, measures, n)
    if changes is not None:
        changes = changes.where(F.col("position") < n).groupBy("node_id", "position").agg(
            *(F.sum(c).alias(c) for c in add)
        ).withColumn("end", F.col("position") + 1)
        spans = spans.unionByName(changes, allowMissingColumns=True)
    if extreme:
        spans = spans.unionByName(_blocks(links, extreme, levels), allowMissingColumns=True)
    # The one shuffle by registration comes before the spans are spread. The number of its
    # partitions is given, as partitions merged by their small size would be spread too.
    parts = SPREAD * int(dump["nodes"].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pick = {m.name: F.min if m.kind == "min" else F.max for m in extreme}
    at = (
        spans.repartition(parts, "node_id")
        .select("*", F.explode(F.sequence("position", F.col("end") - 1)).alias("at"))
        .groupBy("node_id", F.col("at").alias("position"))
        .agg(
            F.sum("born").alias("born"),
            *(F.max(c).alias(c) for c in add),  # of the one row of changes
            *(pick[m.name](m.name).alias(m.name) for m in extreme),
        )
    )
    by_node = Window.partitionBy("node_id").orderBy("position")
    total = by_node.rowsBetween(Window.unboundedPreceding, 0)
    # links may be older than the registration, and nodes outside the sample have links too
    dense = at.select(
        "node_id", "position", "born", *(F.coalesce(F.sum(c).over(total), F.lit(0)).alias(c) for c in add),
        *(m.name for m in extreme),
    ).where(F.col("born") > 0)
    if status is not None:
        dense = dense.withColumn("is_los", status({c: F.col(c) for c in names}).cast("int"))
        dense = dense.withColumn("los_lag", F.lag("is_los").over(by_node))
    # rows of equal node_id are registrations of their own, each with a row per cutoff
    copies = dense.select("*", F.explode(F.sequence(F.lit(1), F.col("born").cast("int"))).alias("copy"))
    panel = copies.select(
        F.element_at(cutoff_array(cutoffs), F.col("position") + 1).alias("date"), "node_id", *names,
        *(
            ["is_los", F.when(F.col("copy") == 1, F.col("los_lag")).otherwise(F.col("is_los")).alias("los_lag")]
            if status is not None
            else []
        ),
    )
    if status is None:
        return panel
    from regspan.operators.history import _los_change

    return panel.withColumn("los_change", _los_change(F.col("los_lag")))
