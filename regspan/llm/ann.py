"""Nearest neighbours by block matrix join: int8 tiles, error bounds, exact scores of survivors.

Vectors are scaled to int8. For x = s*q + e the inner product of two vectors differs from
that of their int8 forms by at most |e_x| |y| + |x'| |e_y|. A tile is one block of
queries against one block of candidates: its int8 product gives bounds for all pairs, and a pair
whose upper bound is below the k-th best lower bound of its query can't be among the k
nearest. What survives is computed in double precision, so the result is exact.
"""

from __future__ import annotations

import heapq
from collections import OrderedDict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regspan.llm.common import stored, table

K = 20
QUERY_EVERY = 20
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096  # rows
_PAIRS = 1 << 15  # computed in double precision at once
_HELD = 16  # query blocks whose best are held by a task

_BLOCK = "block long, dim int, ids binary, vectors binary, small binary, scales binary, errors binary, norms binary"


def valid(vector: Column) -> Column:
    """Whether a vector takes part: no NULL, no component NULL or not finite, not all zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Stored blocks of at most `size` vectors of one dimension, with int8 forms and errors."""

    def block(ids: list, rows: list, number: int):
        import numpy as np

        v = np.array(rows, np.float64)
        scale = np.abs(v).max(axis=1) / 127
        small = np.rint(v / scale[:, None])
        near = small * scale[:, None]
        norms = np.linalg.norm(near, axis=1), np.linalg.norm(v, axis=1)
        return (
            number, v.shape[1], np.array(ids, np.int64).tobytes(), v.tobytes(),
            small.astype(np.int8).tobytes(), scale.tobytes(),
            np.linalg.norm(v - near, axis=1).tobytes(), np.stack(norms).tobytes(),
        )

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, tuple[list, list]] = {}
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
        names = [c.split()[0] for c in _BLOCK.split(", ")]

        def out(dim):
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(block(*held.pop(dim), number), types)], names
            )

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, rows = held.setdefault(len(vector), ([], []))
                ids.append(vec_id)
                rows.append(vector)
                if len(ids) == size:
                    yield out(len(vector))
                    number += 1
        for dim in list(held):
            yield out(dim)
            number += 1

    parts = max(1, -(-vectors.count() // size))
    # Hashed, so that every block has about its size however the input is split.
    dealt = vectors.repartition(parts, F.xxhash64("vec_id"))
    return stored(dealt.mapInArrow(pack, _BLOCK), "ann-blocks")


class _Side:
    def __init__(self, row: dict):
        import numpy as np

        self.ids = np.frombuffer(row["ids"], np.int64)
        shape = len(self.ids), row["dim"]
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(shape)
        self.small = np.frombuffer(row["small"], np.int8).reshape(shape)
        self.scales = np.frombuffer(row["scales"], np.float64)
        self.errors = np.frombuffer(row["errors"], np.float64)
        self.near_norms, self.norms = np.frombuffer(row["norms"], np.float64).reshape(2, -1)


def exact_scores(x, y):
    """Inner products of the rows of x and y, summed in order of the components."""
    import numpy as np

    out = np.zeros(len(x))
    for i in range(x.shape[1]):
        out += x[:, i] * y[:, i]
    return out


def tile(q: _Side, c: _Side, floor, k: int):
    """The k best pairs of each query in a tile: query places, candidate ids, scores.

    floor: for each query a score that the k-th best is known to reach already.
    """
    import numpy as np

    # Integers up to 127 * 127 * dim are exact in single precision up to dim 1040.
    kind = np.float32 if q.small.shape[1] <= 1040 else np.float64
    about = (q.small.astype(kind) @ c.small.astype(kind).T).astype(np.float64)
    about *= q.scales[:, None] * c.scales
    bound = q.errors[:, None] * c.norms + q.near_norms[:, None] * c.errors
    bound += 1e-12 * (q.norms[:, None] * c.norms)  # rounding of the sums themselves
    own = q.ids[:, None] == c.ids
    lower = np.where(own, -np.inf, about - bound)
    if lower.shape[1] >= k:
        floor = np.maximum(floor, np.partition(lower, lower.shape[1] - k, axis=1)[:, -k])
    rows, columns = np.nonzero((about + bound >= floor[:, None]) & ~own)
    scores = np.empty(len(rows))
    for s in range(0, len(rows), _PAIRS):
        part = slice(s, s + _PAIRS)
        scores[part] = exact_scores(q.vectors[rows[part]], c.vectors[columns[part]])
    ids = c.ids[columns]
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    first = np.searchsorted(rows, rows)
    best = np.arange(len(rows)) - first < k
    return rows[best], ids[best], scores[best]


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of largest inner product per query.

    vectors: vec_id, embedding and any other columns; is_query: a condition on them. All
    rows but the query itself are candidates; ties go to the smaller vec_id. Rows that are
    not valid() or have a NULL vec_id take no part, and only vectors of one dimension are
    compared. Rows that repeat a vec_id are searched and found each for itself, except by
    queries of that very id.
    """
    import numpy as np

    spark = vectors.sparkSession
    rows = vectors.where(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
    rows = rows.select("vec_id", "embedding", is_query.alias("is_query"))
    queries = _blocks(rows.where("is_query").drop("is_query"), QUERY_BLOCK)
    candidates = _blocks(rows.drop("is_query"), CANDIDATE_BLOCK)
    # Every group of candidate blocks meets all query blocks: a join on the group's number.
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(groups, candidates.count()))
    left = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        "dim", F.struct(*queries.columns).alias("q"),
    )
    right = candidates.select(
        F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"),
        "dim", F.struct(*candidates.columns).alias("c"),
    )

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        best: OrderedDict[int, tuple] = OrderedDict()

        def flush(block):
            ids, heaps = best.pop(block)
            found = [(int(i), -v, s) for i, heap in zip(ids, heaps) for s, v in heap]
            types = [pa.int64(), pa.int64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([f[j] for f in found], t) for j, t in enumerate(types)],
                ["query_id", "vec_id", "score"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                q, c, block = _Side(pair["q"]), _Side(pair["c"]), pair["q"]["block"]
                if block not in best:
                    best[block] = q.ids, [[] for _ in q.ids]
                best.move_to_end(block)
                heaps = best[block][1]
                floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
                for r, vec_id, score in zip(*(a.tolist() for a in tile(q, c, floor, k))):
                    # The worst of a heap comes first: smallest score, then largest id.
                    if len(heaps[r]) < k:
                        heapq.heappush(heaps[r], (score, -vec_id))
                    else:
                        heapq.heappushpop(heaps[r], (score, -vec_id))
                if len(best) > _HELD:
                    yield flush(next(iter(best)))
        for block in list(best):
            yield flush(block)

    tiles = left.join(right, ["group", "dim"]).select("q", "c")
    found = tiles.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op4: 20 nearest of every 20th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % QUERY_EVERY == 0)
