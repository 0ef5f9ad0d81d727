"""Join shapes that stay splittable when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """`one LEFT JOIN many` for a `many` side with possibly hot keys.

    A hot key on the right of a left join is processed by one task: the left rows may not
    be replicated. The inner join may be split on either side, so it carries the matches,
    and an anti-join against the distinct keys adds the rows without a match. Both branches use
    the same shuffle of `one`.

    Partitions are merged by their size as shuffled, into which very many ids compress. So the
    matches are found in a hash table of `one` while `many` streams by, instead of sorting both;
    and the keys keep the given number of partitions, a hot one being held once.
    """
    matched = one.hint("shuffle_hash").join(many, key)
    parts = int(one.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = many.select(key).repartition(parts, key).distinct()
    unmatched = one.join(keys, key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def left_join_counted(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """The same with repeated rows of `many` as one row and their number as `weight`.

    Rows are counted on the map side before they meet `one`, so a key has no more of them than
    there are different values. A plain left join is enough then, also under an aggregate
    by the same key, which would keep a hot key of a larger join together. Rows of `one` without
    a match have weight 1. Both inputs are read once.
    """
    counted = many.groupBy(*many.columns).agg(F.count(F.lit(1)).alias("weight"))
    return one.join(counted, key, "left").withColumn(
        "weight", F.coalesce("weight", F.lit(1).cast("long"))
    )
