"""Running totals of sparse changes, spread over the cutoffs only at the end.

Counts at a cutoff are kept as changes: +1 where something becomes visible, -1 where it
stops being visible. Shuffles and sorts then see one row per change, not one per cutoff.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from regspan.functions.cutoffs import cutoff_array, cutoffs_id


def by_position(keys: Sequence[str]) -> WindowSpec:
    """Changes of one key in the order of the cutoffs: at most one row per cutoff."""
    return Window.partitionBy(*keys).orderBy("position")


def running(aggregate: Column, keys: Sequence[str]) -> Column:
    """`aggregate` over this and all earlier changes of the key."""
    return aggregate.over(by_position(keys).rowsBetween(Window.unboundedPreceding, 0))


def next_position(keys: Sequence[str], n_cutoffs: int) -> Column:
    """Where the next change of the key applies (or the end): this state holds before it."""
    return F.lead("position", 1, n_cutoffs).over(by_position(keys))


def tied(runs: DataFrame, cutoffs: Sequence[date]) -> DataFrame:
    """Runs without their mark `cutoffs_id`, which must be that of these cutoffs.

    Positions read against another list of cutoffs would give wrong dates, so the query fails.
    """
    same = F.col("cutoffs_id").eqNullSafe(F.lit(cutoffs_id(cutoffs)))
    wrong = F.raise_error(F.lit("the status runs were made for other cutoffs")).cast("int")
    return runs.withColumn("position", F.when(same, F.col("position")).otherwise(wrong)).drop(
        "cutoffs_id"
    )


def spread(runs: DataFrame, cutoffs: Sequence[date]) -> DataFrame:
    """One row per cutoff in [position, next_position), with `date` and `offset` in the run.

    Runs without shuffling, so the dense rows go straight to the writer or to the partial
    aggregation that follows.
    """
    dates = F.slice(
        cutoff_array(cutoffs), F.col("position") + 1, F.col("next_position") - F.col("position")
    )
    return runs.select("*", F.posexplode(dates).alias("offset", "date"))
