"""Column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regspan.schemas import KEY_PATTERN


def mined_key(text: Column | str) -> Column:
    """First identifier-like run in a text: '' without one, NULL for NULL."""
    return F.regexp_extract(text, KEY_PATTERN, 0)


def sum_if(condition: Column) -> Column:
    """Number of rows where `condition` is true; NULL if it is NULL on all of them."""
    return F.sum(condition.cast("int"))


def is_true(condition: Column) -> Column:
    """`condition` as 0/1, NULL counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")
