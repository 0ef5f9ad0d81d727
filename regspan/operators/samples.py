"""Which registrations are looked at, and when."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspan.functions.cutoffs import cutoff_sequence
from regspan.schemas import NODE_TYPE_PREFIX, VALID_REGISTRATION
from regspan.sources.dump import Dump

# A sample is a list of predicates on the node table, all of which must hold.
Sample = Sequence["Column | str"] | None


def sample_filter(df: DataFrame, sample: Sample) -> DataFrame:
    """Rows on which every predicate of the sample is true."""
    predicates = [F.expr(p) if isinstance(p, str) else p for p in sample or ()]
    return df.where(reduce(Column.__and__, predicates)) if predicates else df


def nodes(dump: Dump, sample: Sample = None, nodetype: str = "registration") -> DataFrame:
    """Nodes of one type, restricted to a sample."""
    of_type = dump["nodes"].where(F.col("type") == NODE_TYPE_PREFIX + nodetype)
    return sample_filter(of_type, sample)


def valid_registrations(dump: Dump) -> DataFrame:
    """Public, accepted, registered, not deleted, not spam: by their state of today."""
    return nodes(dump, VALID_REGISTRATION)


def cutoff_spine(df: DataFrame, start: Column, end: Column, step: str = "month") -> DataFrame:
    """Cutoffs in order for the span given by two date columns (`df` has one row per span)."""
    return df.select(F.explode(cutoff_sequence(start, end, step)).alias("date")).orderBy("date")


def activity_span(dump: Dump) -> DataFrame:
    """One row: first day of the month of the first registration, and day of the last one."""
    created = nodes(dump).select(F.to_date("created").alias("created"))
    return created.agg(
        F.trunc(F.min("created"), "month").alias("start"), F.max("created").alias("end")
    )
