"""Compare a Spark result with the result of its SQL in DuckDB, as bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with every given table of one scale as a view."""
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def differences(spark_df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; empty if the rows are the same."""
    relation = connection.sql(sql)
    if sorted(spark_df.columns) != sorted(relation.columns):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(relation.columns)}"]
    order = sorted(spark_df.columns)
    ours = Counter(tuple(row) for row in spark_df.select(*(f"`{c}`" for c in order)).collect())
    theirs = Counter(
        connection.sql(sql).select(*(f'"{c}"' for c in order)).fetchall()
    )
    found = []
    if ours.total() != theirs.total():
        found.append(f"{ours.total()} rows vs {theirs.total()}")
    for name, surplus in (("ours", ours - theirs), ("theirs", theirs - ours)):
        if surplus:
            found.append(f"only in {name}: {surplus.total()}, e.g. {next(iter(surplus))}")
    return found
