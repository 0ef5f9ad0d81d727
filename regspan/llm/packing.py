"""Best-fit packing by length histogram: the plan is made over counts, not documents.

Documents become pieces of at most `capacity` tokens. Best-fit decreasing runs on the driver
over the number of pieces of each length, at most `capacity` numbers whatever the amount of
data; sequences of equal content are one group throughout. A row of the plan says where
pieces of a length with ranks in a range go. Pieces take their slots by joining on rank.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regspan.llm.common import stored, table
from regspan.llm.tokens import encoder

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLAN = (
    "length long, rank_from long, rank_to long, first_sequence long, in_each long, at long"
)


def pieces_of(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: PIECES, and ids (binary, 32-bit little-endian) on request."""
    schema = PIECES + (", ids binary" if with_ids else "")
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = encoder(tokenizer, "drop")
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            types, names = [*types, pa.binary()], [*names, "ids"]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    row = (doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names
            )

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Best-fit decreasing over a histogram of lengths; rows as in _PLAN.

    Pieces of a length with rank in [rank_from, rank_to) go to sequences from
    first_sequence on, in_each to a sequence, the first of them at offset `at`.
    """
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: [(first, number)]
    plan, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        for room in sorted(r for r in free if r >= length):
            groups, fit = free.pop(room), room // length
            while left and groups:
                first, number = groups.pop()
                full = min(number, left // fit)
                if full:
                    plan.append((length, rank, rank + full * fit, first, fit, capacity - room))
                    free[room - fit * length].append((first, full))
                    rank, left = rank + full * fit, left - full * fit
                first, number = first + full, number - full
                if number and 0 < left < fit:
                    plan.append((length, rank, rank + left, first, left, capacity - room))
                    free[room - left * length].append((first, 1))
                    rank, left = rank + left, 0
                    first, number = first + 1, number - 1
                if number:
                    groups.append((first, number))
            if groups:
                free[room].extend(groups)
            if not left:
                break
        fit = capacity // length
        for number, each in ((left // fit, fit), (1, left % fit)):
            if number and each:
                plan.append((length, rank, rank + number * each, sequences, each, 0))
                free[capacity - each * length].append((sequences, number))
                rank, sequences = rank + number * each, sequences + number
    return plan


def _ranked(pieces: DataFrame) -> DataFrame:
    """rank of each piece within its length, from 0, in any fixed order.

    A length may be that of most pieces, so rows are numbered within (length, salt) and
    moved on by the counts of earlier salts.
    """
    spark = pieces.sparkSession
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    totals = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    moves = totals.select(
        "length", "salt", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("move")
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (
        salted.withColumn("place", F.row_number().over(within) - 1)
        .join(moves, ["length", "salt"])
        .withColumn("rank", F.col("place") + F.col("move"))
        .drop("salt", "place", "move")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset.

    pieces: a stored table with PIECES and any other columns. Lengths run from 1 to capacity;
    rows may repeat, each row takes a slot of its own. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    counts = {
        r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()
    }  # at most `capacity` rows
    slots = spark.createDataFrame(plan_slots(counts, capacity), _PLAN)
    # The plan has a few rows per length, so its size is bounded by the capacity.
    inside = (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    ranked = _ranked(pieces)
    place = F.col("rank") - F.col("rank_from")
    return (
        ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & inside)
        .select(
            *(ranked[c] for c in pieces.columns),
            (F.col("first_sequence") + F.floor(place / F.col("in_each"))).alias("sequence_id"),
            (F.col("at") + place % F.col("in_each") * ranked["length"]).alias("offset"),
        )
    )


def packed(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """All documents (doc_id, text) packed: PIECES, sequence_id, offset, ids on request.

    A NULL or empty text is its end id alone. Only longer documents are cut. Rows with NULL
    or repeated ids are packed as documents of their own.
    """
    return pack(stored(pieces_of(docs, tokenizer, with_ids=with_ids), "pack-pieces"))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the place of every piece."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packed(table(spark, sf_dir, "documents"), path)
