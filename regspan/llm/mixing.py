"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Every source gets a target size. A document is taken `copies` times: as often as the target
holds the whole source, and once more if the hash of its id lies below the threshold of its
source. Thresholds come from histograms of words by source and hash bucket: the bucket in
which the running total passes the target is the boundary, and only documents in it are
counted again, by finer buckets, until it cannot be divided. Nothing is sorted but bucket
totals, and a larger target takes a superset of the documents (nested thresholds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regspan.llm.common import row_and, stored, word_count

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
_BITS = 12  # of the hash at each level: up to 4096 buckets per source
_LEVELS = 5
_SALTS = 64  # parts over which rows of one source are joined to its plan


def _hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id as text: the same in every engine. NULL counts as ''."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def _prefix(level: int) -> Column:
    """The first bits of the hash as a number."""
    return F.shiftright("hash", _BITS * (_LEVELS - level))


def _measured(docs: DataFrame) -> dict[str, Column]:
    source = docs["source"].cast("string")
    return {
        "no_source": source.isNull(),
        "source_name": F.coalesce(source, F.lit("")),
        "size": word_count(docs["text"]),
        "hash": _hash(docs["doc_id"]),
    }


_SOURCE = ["no_source", "source_name"]


def _targets(sized: DataFrame, weights, max_repeats: int) -> DataFrame:
    """One row per source: source_size, target.

    The level at which a source of weight 1 is filled rises as sources stop at their limit;
    each step is one sum over the small table of sources.
    """
    order = Window.orderBy(*_SOURCE)  # one row per source is left here
    place = (F.row_number().over(order) - 1) % len(weights)
    sources = stored(
        sized.groupBy(*_SOURCE)
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
        .withColumn("limit", F.col("source_size").cast("double") * max_repeats),
        "mix-sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = F.col("limit") < F.col("weight") * F.lit(level)
        n, used, weight = sources.agg(
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)),
            F.sum(F.when(~full, F.col("weight"))),
        ).first()
        if n == stopped or not weight:
            break
        level, stopped = (total - used) / weight, n
    return sources.select(
        *_SOURCE,
        "source_size",
        F.least(F.col("limit"), F.col("weight") * F.lit(level)).alias("target"),
    )


def _thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds to each source: whole (copies of everything), cut and take_cut.

    One more copy is taken of hashes whose prefix is below `cut`, and of those equal to it
    if take_cut. After the last level rows of a boundary agree in 60 bits, which happens
    for repeated rows only; they are taken if that comes nearer to the target.
    """
    size = F.col("source_size")
    plan = targets.withColumn(
        "whole", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int")
    ).withColumn("want", F.col("target") - F.col("whole") * size)
    inside, edge = sized, plan.select(*_SOURCE, "want")
    for level in range(1, _LEVELS + 1):
        bucket = _prefix(level).alias("cut")
        histogram = inside.groupBy(*_SOURCE, bucket).agg(F.sum("size").alias("words"))
        upto = Window.partitionBy(*_SOURCE).orderBy("cut")  # at most 4096 rows each
        passed = (
            histogram.join(edge.select(*_SOURCE, "want"), _SOURCE)
            .withColumn("sum", F.sum("words").over(upto))
            .where(F.col("sum") > F.col("want"))
        )
        edge = stored(
            passed.groupBy(*_SOURCE).agg(
                F.min(F.struct("cut", "words", (F.col("want") - F.col("sum") + F.col("words")).alias("want"))).alias("e")
            ).select(*_SOURCE, "e.*"),
            "mix-edges",
        )
        if level < _LEVELS:
            inside = sized.join(
                edge.withColumnRenamed("cut", "at"),
                [*(sized[c] == edge[c] for c in _SOURCE), _prefix(level) == F.col("at")],
                "left_semi",
            )
    take = (F.col("want") * 2 >= F.col("words")).alias("take_cut")
    return plan.join(edge.select(*_SOURCE, "cut", take), _SOURCE, "left").drop("want")


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the plan of their source; sources of any size are spread over salts."""
    spread = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    prefix = _prefix(_LEVELS)
    more = (prefix < F.col("cut")) | ((prefix == F.col("cut")) & F.col("take_cut"))
    return (
        rows.withColumn("salt", F.pmod(F.col("hash"), F.lit(_SALTS)).cast("int"))
        .join(spread, [*_SOURCE, "salt"])
        .withColumn("copies", F.col("whole") + F.coalesce(more, F.lit(False)).cast("int"))
    )


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Every document with the number of copies that the mixture takes.

    docs: doc_id, text, source and any other columns. Returns: row (struct of all input
    columns), size, source_size, target, copies (0 to max_repeats).

    Sources by code point, NULL last, weigh `weights` in turn and share the words of all
    documents; a target stops at max_repeats times its source. A NULL or empty text has
    size 0. Rows with equal doc_id share a hash, so they are taken alike; with distinct ids a
    source misses its target by half of one document at most. The choice depends on doc_id
    and the totals only, so reruns agree.
    """
    narrow = stored(
        docs.select(*(c.alias(n) for n, c in _measured(docs).items())), "mix-sizes"
    )
    plan = stored(_thresholds(narrow, _targets(narrow, weights, max_repeats)), "mix-plan")
    return _with_copies(row_and(docs, **_measured(docs)), plan).select(
        "row", "size", "source_size", "target", "copies"
    )


def mixed(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixture itself: input rows, each as often as it is taken."""
    chosen = mix(docs, weights, max_repeats)
    return chosen.select(
        F.explode(F.array_repeat("row", F.col("copies"))).alias("row")
    ).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: words that the mix takes of every document."""
    from regspan.llm.common import table

    docs = table(spark, sf_dir, "documents")
    return mix(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )
