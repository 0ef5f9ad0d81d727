"""Grand totals next to the lines they are the total of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_total(lines: DataFrame, measure: str, within: Sequence[str] = ()) -> DataFrame:
    """Add `total`: the sum of `measure` over all lines that agree in `within`.

    A subquery or a join with the totals would compute the lines twice, and a window over
    all of them would be a single task. Here every line also contributes to an extra row
    that is summed on the map side first, and a copy of the finished total travels to each
    split of the lines. Lines must be distinct. There are as many splits as the session has
    shuffle partitions.
    """
    splits = max(1, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    others = [c for c in lines.columns if c not in within]
    line = F.struct(*(F.col(f"`{c}`") for c in others)).alias("line")
    with_contribution = lines.select(
        *within, F.col(measure).alias("total"), F.explode(F.array(line, F.lit(None))).alias("line")
    )
    summed = with_contribution.groupBy(*within, "line").agg(F.sum("total").alias("total"))
    is_total = F.col("line").isNull()
    everywhere = F.sequence(F.lit(0), F.lit(splits - 1))
    one_split = F.array(F.pmod(F.xxhash64("line"), F.lit(splits)).cast("int"))
    placed = summed.withColumn(
        "split", F.explode(F.when(is_total, everywhere).otherwise(one_split))
    )
    of_split = Window.partitionBy(*within, "split")
    return (
        placed.withColumn("total", F.max(F.when(is_total, F.col("total"))).over(of_split))
        .where(F.col("line").isNotNull())
        .select(*within, "line.*", "total")
        .select(*lines.columns, "total")
    )
