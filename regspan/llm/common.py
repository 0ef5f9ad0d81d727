"""Helpers shared by the training-data operators: input tables, scratch tables, words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One word: a run of characters other than ASCII white space (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark, so that any store that Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only where the session names none and runs in local mode, as in tests on one machine, a
    folder is made and the setting is kept in the session for later calls. Elsewhere a folder
    of the driver's machine would not be seen by the executors, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df as a table in the shared folder: cuts the lineage, survives executors.

    Every call takes a new path; the table is left to the owner of the folder to delete, as
    results read from it lazily.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL.

    Counts pieces between white space. A piece is empty only at the ends of the text.
    """
    pieces = F.split(text, r"[\x20\x09-\x0D]+")
    edges = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0) + F.when(
        (F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1
    ).otherwise(0)
    return F.coalesce((F.size(pieces) - edges).cast("long"), F.lit(0).cast("long"))


def row_and(docs: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row as struct `row` beside computed columns.

    Input columns of any name thus never clash with what an operator computes.
    """
    return docs.select(F.struct("*").alias("row"), *(c.alias(n) for n, c in columns.items()))
