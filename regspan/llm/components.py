"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regspan.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v, each once.

    Large: every node sends its larger neighbours to its smallest neighbour or itself. Small:
    every node sends itself and its smaller neighbours to the smallest of them. Minima are
    aggregated before the join, so a node with very many neighbours is no group of rows in
    one task: its side of the join can be split.
    """
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the smallest node reached.

    Roots are not listed themselves. Edges may repeat, run both ways or be loops.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.where("u > v").distinct(), "star-edges")
    mark = None
    while True:
        edges = stored(_star(_star(edges, large=True), large=False), "star-edges")
        # Unchanged edges are stars: count and sum of hashes tell.
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
