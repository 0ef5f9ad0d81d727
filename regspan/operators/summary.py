"""Counts and shares of registrations by date and attribute."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regspan.functions.columns import is_true
from regspan.functions.cutoffs import check_cutoffs
from regspan.functions.timeline import by_position, next_position, running, spread, tied
from regspan.functions.totals import with_total
from regspan.schemas import OVERALL, SUPPORTED_ATTRIBUTES

COUNTS = ("n_osr", "have_resources", "have_outputs", "have_outcomes", "are_los")
SHARES = ("prop_osr", "prop_resources", "prop_outputs", "prop_outcomes", "prop_los")


def _flags() -> dict[str, Column]:
    """What a panel row adds to each count, as 0/1."""
    return {
        "n_osr": F.lit(1),
        "have_resources": is_true(F.col("net_resources") > 0),
        "have_outputs": is_true(F.col("net_outputs") > 0),
        "have_outcomes": is_true(F.col("net_outcomes") > 0),
        "are_los": F.coalesce(F.col("is_los"), F.lit(0)),
    }


def _with_shares(counts: DataFrame, share_within: Sequence[str] = ()) -> DataFrame:
    """Proportions. `prop_osr` relates to the sum over all rows of the result, or over the
    rows that agree in `share_within`."""
    shares = {
        "prop_osr": F.col("n_osr") / F.col("total"),
        "prop_resources": F.col("have_resources") / F.col("n_osr"),
        "prop_outputs": F.col("have_outputs") / F.col("n_osr"),
        "prop_outcomes": F.col("have_outcomes") / F.col("n_osr"),
        "prop_los": F.col("are_los") / F.col("n_osr"),
    }
    return with_total(counts, "n_osr", share_within).withColumns(shares).drop("total")


def los_summarizer(
    df: DataFrame,
    *group_cols: str,
    threshold: float = 0.0,
    share_within: Sequence[str] = (),
) -> DataFrame:
    """Counts and shares of panel rows by any columns, largest LOS share first.

    Groups with less than `threshold` of all rows are left out.
    """
    if isinstance(threshold, bool) or not isinstance(threshold, (int, float)):
        raise ValueError("threshold must be a number")
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie between 0 and 1")
    counts = df.groupBy(*group_cols).agg(*(F.sum(f).alias(c) for c, f in _flags().items()))
    rest = [c for c in COUNTS + SHARES if c not in ("n_osr", "prop_los")]
    return (
        _with_shares(counts, share_within)
        .where(F.col("prop_osr") >= threshold)
        .orderBy(F.desc("prop_los"))
        .select(*group_cols, "n_osr", "prop_los", *rest)
    )


def _weighted(bag: DataFrame, *columns: str) -> DataFrame:
    """A bag with repeated rows counted, if they have no weight already. A registration then has
    no more rows than the report has lines, whatever the bag repeats."""
    weight = F.sum("weight") if "weight" in bag.columns else F.count("*")
    return bag.groupBy("node_id", *columns).agg(weight.alias("weight"))


def summary_lines(
    panel: DataFrame,
    attribute: str = OVERALL,
    bag: DataFrame | None = None,
    share_within: Sequence[str] = (),
) -> DataFrame:
    """`los_summary_by_attribute` in no order: what other operators build on."""
    flags = panel.select("node_id", "date", *(f.alias(c) for c, f in _flags().items()))
    if attribute == OVERALL:
        keys, weight = ["date"], F.lit(1)
    else:
        if bag is None:
            raise ValueError(f"attribute {attribute} needs a bag")
        flags = flags.join(_weighted(bag, attribute), "node_id", "left")
        keys, weight = [attribute, "date"], F.coalesce("weight", F.lit(1))
    counts = flags.groupBy(*keys).agg(*(F.sum(F.col(c) * weight).alias(c) for c in COUNTS))
    return _with_shares(counts, share_within).select(*keys, *COUNTS, *SHARES)


def los_summary_by_attribute(
    panel: DataFrame,
    attribute: str = OVERALL,
    bag: DataFrame | None = None,
    share_within: Sequence[str] = (),
) -> DataFrame:
    """Counts and shares of a panel by date and one attribute, largest LOS share first.

    `bag` holds (node_id, <attribute>). Registrations without a row there count under NULL.
    "overall" groups by date only.
    """
    return summary_lines(panel, attribute, bag, share_within).orderBy(F.desc("prop_los"))


def _check_attributes(attributes: Sequence[str]) -> list[str]:
    if isinstance(attributes, str) or not attributes:
        raise ValueError("attributes must be a list with at least one name")
    unknown = set(attributes) - {*SUPPORTED_ATTRIBUTES, OVERALL}
    if unknown:
        raise ValueError(f"unknown attributes: {sorted(unknown)}")
    return list(attributes)


def _count_by_subgroup(
    rows: DataFrame, time: str, bag: DataFrame, attributes: Sequence[str]
) -> DataFrame:
    """Sums of the counts of `rows` by attribute, subgroup and time.

    Registrations without a row in the bag for an attribute count once under NULL there, as
    after a left join per attribute. They are not looked up: NULL gets the sum over all
    registrations less the sum over those that have rows for the attribute, and the one join
    made anyway yields both. "overall" is the attribute no registration has rows for.
    """
    if set(attributes) == {OVERALL}:
        sums = (F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS)
        nobody = F.lit(None).cast("string").alias("subgroup")
        overall = rows.groupBy(time).agg(*sums)
        return overall.select(F.lit(OVERALL).alias("attribute"), nobody, time, *COUNTS)
    # A registration has at most as many of these rows as the report has lines. The number of
    # partitions is given: merged to a size in bytes as shuffled, they would hold as many rows as
    # compress into it, and with them the rows of the panel that meet them here and are sorted.
    parts = int(bag.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weighted = _weighted(
        bag.where(F.col("attribute").isin(*attributes)), "attribute", "subgroup"
    ).repartition(parts, "node_id")
    of_attribute = Window.partitionBy("node_id", "attribute").orderBy("subgroup")
    of_node = Window.partitionBy("node_id").orderBy("attribute", "subgroup")
    marked = weighted.withColumns(
        {
            "once_in_attribute": F.row_number().over(of_attribute) == 1,
            "once_in_all": F.row_number().over(of_node) == 1,
        }
    )
    once = F.coalesce("once_in_all", F.lit(True))
    lines = (
        rows.join(marked, "node_id", "left")
        .groupBy("attribute", "subgroup", time)
        .agg(
            *(F.sum(F.col(c) * F.col("weight")).alias(f"own_{c}") for c in COUNTS),
            *(
                F.sum(F.when(F.col("once_in_attribute"), F.col(c))).alias(f"covered_{c}")
                for c in COUNTS
            ),
            *(F.sum(F.when(once, F.col(c)).otherwise(0)).alias(f"all_{c}") for c in COUNTS),
        )
    )

    def entry(attribute: Column, subgroup: Column, counts: Sequence[Column]) -> Column:
        named = [count.alias(c) for count, c in zip(counts, COUNTS)]
        return F.struct(attribute.alias("attribute"), subgroup.alias("subgroup"), *named)

    nobody = F.lit(None).cast("string")
    of_line = F.array(
        entry(F.col("attribute"), F.col("subgroup"), [F.col(f"own_{c}") for c in COUNTS]),
        entry(F.col("attribute"), nobody, [-F.col(f"covered_{c}") for c in COUNTS]),
        *(entry(F.lit(a), nobody, [F.col(f"all_{c}") for c in COUNTS]) for a in attributes),
    )
    return (
        lines.select(time, F.inline(of_line))
        .where(F.col("attribute").isNotNull())
        .groupBy("attribute", "subgroup", time)
        .agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS))
    )


def _finish_all(counts: DataFrame) -> DataFrame:
    shares = _with_shares(counts.where(F.col("n_osr") > 0), ["attribute"])
    return shares.select("attribute", "subgroup", "date", *COUNTS, *SHARES)


def los_summary_all(
    panel: DataFrame,
    bag: DataFrame | None,
    attributes: Sequence[str] = (*SUPPORTED_ATTRIBUTES, OVERALL),
) -> DataFrame:
    """`los_summary_by_attribute` for several attributes in one table.

    `bag` holds (node_id, attribute, subgroup); overall alone needs none. The panel is read once.
    """
    attributes = _check_attributes(attributes)
    flags = panel.select("node_id", "date", *(f.alias(c) for c, f in _flags().items()))
    return _finish_all(_count_by_subgroup(flags, "date", bag, attributes))


def _flag_changes(runs: DataFrame) -> DataFrame:
    """Runs at which a count flag of the registration changes, with the change."""
    in_time = by_position(["node_id"])
    flags = runs.select("node_id", "position", *(f.alias(c) for c, f in _flags().items()))
    changes = flags.select(
        "node_id",
        "position",
        *((F.col(c) - F.lag(c, 1, 0).over(in_time)).alias(c) for c in COUNTS),
    )
    return changes.where(reduce(Column.__or__, (F.col(c) != 0 for c in COUNTS)))


def los_summary_of_runs(
    runs: DataFrame,
    bag: DataFrame | None,
    cutoffs: Sequence[date | str],
    attributes: Sequence[str] = (*SUPPORTED_ATTRIBUTES, OVERALL),
) -> DataFrame:
    """`los_summary_all` from status runs, without building the panel.

    Only the few cutoffs at which a flag of a registration changes are joined to the
    attributes and shuffled. Running totals per subgroup turn the added-up changes into
    counts, and the cutoffs are spread out on the finished lines.
    """
    attributes = _check_attributes(attributes)
    cutoffs = check_cutoffs(cutoffs)
    rows = _flag_changes(tied(runs, cutoffs))
    changes = _count_by_subgroup(rows, "position", bag, attributes)
    keys = ["attribute", "subgroup"]
    totals = changes.select(
        *keys,
        "position",
        next_position(keys, len(cutoffs)).alias("next_position"),
        *(running(F.sum(c), keys).alias(c) for c in COUNTS),
    )
    return _finish_all(spread(totals, cutoffs).select(*keys, "date", *COUNTS))


def los_leaderboard(attribute_bag: DataFrame, counts: DataFrame, attribute: str) -> DataFrame:
    """LOS registrations per attribute value, largest share first.

    `counts` is a snapshot; registrations in the bag but not in it count as not LOS.
    """
    status = counts.select("node_id", "is_los")
    grouped = (
        _weighted(attribute_bag, attribute)
        .join(status, "node_id", "left")
        .groupBy(attribute)
        .agg(
            F.sum("weight").alias("n_regs"),
            F.coalesce(F.sum(F.col("is_los") * F.col("weight")), F.lit(0)).alias("n_los"),
        )
    )
    return grouped.withColumn("prop_los", F.col("n_los") / F.col("n_regs")).orderBy(
        F.desc("prop_los")
    )


def latest_snapshot(
    summary: DataFrame, attribute: str | None = None, latest: date | None = None
) -> DataFrame:
    """Summary lines of the latest date with the measures shown in tables.

    Where the latest date is known, naming it saves looking for it in the finished lines.
    """
    latest = F.lit(latest) if latest else summary.select(F.max("date")).scalar()
    return summary.where(F.col("date") == latest).select(
        *([attribute] if attribute else []),
        "n_osr",
        "are_los",
        "prop_los",
        "have_outputs",
        "prop_outputs",
        "have_outcomes",
        "prop_outcomes",
    )
