"""Reading the relational dump."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from regspan.schemas import TABLE_COLUMNS, TABLE_FILES

_FAMILIES = {
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "string": (T.StringType,),
    "boolean": (T.BooleanType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


_UTC = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _check_zone(df: DataFrame, table: str) -> None:
    """Cutoffs are days of UTC; a zoned column compared in another zone would move them."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    if zoned and zone not in _UTC:
        raise ValueError(f"table {table}: {zoned[0]} has a time zone, so the session must be in UTC, not {zone}")


def check_columns(df: DataFrame, table: str) -> DataFrame:
    """Keep the declared columns of `table`; raise if one is missing or of another kind,
    or holds zoned times in a session that is not in UTC."""
    found = {field.name: field.dataType for field in df.schema}
    problems = []
    for column, family in TABLE_COLUMNS[table].items():
        if column not in found:
            problems.append(f"{column} is missing")
        elif not isinstance(found[column], _FAMILIES[family]):
            problems.append(f"{column} is {found[column].simpleString()}, expected {family}")
    if problems:
        raise ValueError(f"table {table}: " + "; ".join(problems))
    declared = df.select(*(f"`{column}`" for column in TABLE_COLUMNS[table]))
    _check_zone(declared, table)
    return declared


def scan_table(spark: SparkSession, table: str, base_dir: str | None = None) -> DataFrame:
    """Lazy scan of one Parquet table below `base_dir` (default: the PARQUET_DIR variable).

    The tables the operators use are opened by their short name and checked; any other name
    is taken as that of a file.
    """
    base_dir = base_dir or os.environ.get("PARQUET_DIR")
    if not base_dir:
        raise ValueError("give base_dir or set PARQUET_DIR")
    df = spark.read.parquet(f"{base_dir.rstrip('/')}/{TABLE_FILES.get(table, table)}.parquet")
    return check_columns(df, table) if table in TABLE_FILES else df


class Dump(Mapping):
    """The source tables by name, each opened when first used."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in TABLE_FILES:
            raise KeyError(table)
        if table not in self._opened:
            self._opened[table] = self._load(table)
        return self._opened[table]

    def __iter__(self):
        return iter(TABLE_FILES)

    def __len__(self) -> int:
        return len(TABLE_FILES)


def open_dump(spark: SparkSession, base_dir: str | None = None) -> Dump:
    """All tables of a Parquet dump."""
    return Dump(lambda table: scan_table(spark, table, base_dir))
