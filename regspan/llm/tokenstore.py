"""Token ids in files: canonical length-limited Huffman code, independent blocks, checkpoints.

A store is a folder with two Parquet tables, so that any file system that Spark writes will do:

codebook  id, bits: code lengths; codes follow canonically (by length, then id)
blocks    start (ids of all documents before the block), n_ids, doc_ids and doc_sizes of its
          documents in order, payload (bits of the codes, first bit highest), checkpoints (bit
          offsets of every STEP-th id, 32-bit little-endian)

A block holds whole documents and is read on its own. Decoding starts at all checkpoints of a
block at once and moves one id a step by table look-up.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from math import ceil, log2

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regspan.llm.common import scratch_dir, stored, table
from regspan.llm.tokens import encoder

END_ID = 0
BLOCK = 1 << 17  # ids; a block is closed by the document that reaches it
STEP = 128
MAX_BITS = 20


def code_lengths(counts, limit: int):
    """Bits of each symbol of an optimal code of at most `limit` bits (package-merge)."""
    import numpy as np

    counts = np.asarray(counts, np.int64)
    bits = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        bits[used] = 1
        return bits
    used = used[np.argsort(counts[used], kind="stable")]
    weights, packages, leaves = counts[used], np.empty(0, np.int64), []
    for _ in range(limit):
        pairs = packages[: len(packages) // 2 * 2].reshape(-1, 2).sum(axis=1)
        every = np.concatenate([weights, pairs])
        order = np.argsort(every, kind="stable")
        leaves.append(order < len(weights))
        packages = every[order]
    take, lengths = 2 * len(used) - 2, np.zeros(len(used), np.uint8)
    for is_leaf in reversed(leaves):
        chosen = int(is_leaf[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    bits[used] = lengths
    return bits


def canonical_codes(bits):
    """Codes of the lengths: counted up in order of length, then symbol."""
    import numpy as np

    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    codes, code, last = np.zeros(len(bits), np.uint64), 0, 0
    for symbol in order.tolist():
        length = int(bits[symbol])
        code <<= length - last
        codes[symbol], last = code, length
        code += 1
    return codes


def encode_ids(ids, codes, bits) -> tuple[bytes, bytes]:
    """Payload and checkpoints of an array of ids."""
    import numpy as np

    length = bits[ids].astype(np.int64)
    ends = np.cumsum(length)
    at = ends - length
    word, room = at >> 6, 64 - (at & 63) - length
    code = codes[ids]
    out = np.zeros((int(ends[-1]) + 63 >> 6) + 1, np.uint64)
    high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.bitwise_or.reduceat(high, first)
    over = np.flatnonzero(room < 0)
    out[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    payload = out.astype(">u8").tobytes()[: int(ends[-1]) + 7 >> 3]
    return payload, at[::STEP].astype("<u4").tobytes()


def decode_table(bits):
    """For every MAX_BITS bits that may come next: id * 32 + bits of its code."""
    import numpy as np

    order = np.lexsort((np.arange(len(bits)), bits))
    order = order[bits[order] > 0]
    spans = np.left_shift(1, MAX_BITS - bits[order].astype(np.int64))
    out = np.zeros(1 << MAX_BITS, np.uint32)
    filled = np.repeat(order.astype(np.uint32) * 32 + bits[order], spans)
    out[: len(filled)] = filled
    return out


def decode_ids(payload: bytes, checkpoints: bytes, n_ids: int, lookup):
    """The ids of a block."""
    import numpy as np

    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    window = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
    at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
    out, last = np.empty((STEP, len(at)), np.uint32), len(window) - 1
    for row in out:
        peek = window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)
        found = lookup[peek >> np.uint32(32 - MAX_BITS)]
        row[:] = found >> np.uint32(5)
        at += found & np.uint32(31)
    return out.T.reshape(-1)[:n_ids]


def _tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Stored ids of all documents, shards in ascending order of doc_id.

    shard, place (row in the shard), before (ids before the row in its shard), doc_id,
    n_tokens, ids (16-bit where the vocabulary allows it, else 32-bit).
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = end_id.to_bytes(4, "little")

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        shard, encode_all = TaskContext.get().partitionId(), encoder(tokenizer, "keep").many
        place = before = 0
        for batch in batches:
            rows = []
            for doc_id, found in zip(batch.column(0).to_pylist(), encode_all(batch.column(1))):
                ids = np.frombuffer(found + end, "<u4")
                packed = ids.astype("<u2") if int(ids.max()) < 1 << 16 else ids
                rows.append((place, before, doc_id, len(ids), packed.itemsize, packed.tobytes()))
                place, before = place + 1, before + len(ids)
            columns = zip(*rows) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(rows), pa.int32())]
                + [pa.array(c, t) for c, t in zip(columns, types)],
                ["shard", "place", "before", "doc_id", "n_tokens", "width", "ids"],
            )

    ordered = docs.select("doc_id", "text").repartitionByRange(shards, "doc_id")
    return stored(
        ordered.sortWithinPartitions("doc_id", "text").mapInArrow(
            encode,
            "shard int, place long, before long, doc_id long, n_tokens long, width int, ids binary",
        ),
        "token-ids",
    )


def _counts(ids: DataFrame) -> dict[int, int]:
    """How often each id occurs: at most the size of the vocabulary."""

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for batch in batches:
            for width, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                new = np.bincount(np.frombuffer(data.as_buffer(), f"<u{width}"))
                if len(new) > len(total):
                    total, new = new, total
                total[: len(new)] += new
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = ids.select("width", "ids").mapInArrow(count, "id long, n long")
    return {r["id"]: r["n"] for r in rows.groupBy("id").agg(F.sum("n").alias("n")).collect()}


_BLOCKS = (
    "start long, n_ids long, doc_ids array<long>, doc_sizes array<long>, payload binary, "
    "checkpoints binary"
)


def _blocks(ids: DataFrame, starts: dict[int, int], bits, codes) -> DataFrame:
    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, follows = [], None

        def block():
            every = np.concatenate([np.frombuffer(r["ids"], f"<u{r['width']}") for r in held])
            payload, checkpoints = encode_ids(every.astype(np.int64), codes, bits)
            first = held[0]
            row = {
                "start": starts[first["shard"]] + first["before"],
                "n_ids": len(every),
                "doc_ids": [r["doc_id"] for r in held],
                "doc_sizes": [r["n_tokens"] for r in held],
                "payload": payload,
                "checkpoints": checkpoints,
            }
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema(
            [
                ("start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                ("doc_sizes", pa.list_(pa.int64())), ("payload", pa.binary()),
                ("checkpoints", pa.binary()),
            ]
        )
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["shard"], row["place"]) != follows:
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += row["n_tokens"]
                follows = row["shard"], row["place"] + 1
                if size >= BLOCK:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    return ids.mapInArrow(pack, _BLOCKS)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode all documents (doc_id, text) and write them as a store at path.

    A NULL or empty text is its end id alone. Documents are in ascending order of doc_id, NULL
    first; rows of equal doc_id by text.
    """
    import numpy as np

    spark = docs.sparkSession
    ids = _tokenized(docs, tokenizer, end_id)
    counts = _counts(ids)
    dense = np.zeros(max(counts, default=0) + 1, np.int64)
    for symbol, n in counts.items():
        dense[symbol] = n
    if len(counts) > 1 << MAX_BITS:
        raise ValueError(f"more than {1 << MAX_BITS} different ids")
    limit = min(MAX_BITS, max(16, ceil(log2(max(2, len(counts)))) + 2))
    bits = code_lengths(dense, limit)
    spark.createDataFrame(
        [(int(i), int(bits[i])) for i in np.flatnonzero(bits)], "id long, bits int"
    ).coalesce(1).write.parquet(f"{path}/codebook")
    # One number per shard.
    sums = ids.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()
    starts, total = {}, 0
    for row in sorted(sums):
        starts[row["shard"]], total = total, total + row["n"]
    blocks = _blocks(ids, starts, bits, canonical_codes(bits))
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def read_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a store: doc_id, start, n_tokens, ids_crc32, ids (32-bit little-endian).

    All ids are decoded in any case; without `with_ids` they are not returned.
    """
    import numpy as np

    rows = spark.read.parquet(f"{path}/codebook").collect()  # at most the vocabulary
    bits = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        bits[r["id"]] = r["bits"]

    def unpack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lookup = decode_table(bits)
        for batch in batches:
            for block in batch.to_pylist():
                ids = decode_ids(block["payload"], block["checkpoints"], block["n_ids"], lookup)
                data = ids.astype("<u4").tobytes()
                at, out = 0, []
                for doc_id, size in zip(block["doc_ids"], block["doc_sizes"]):
                    part = data[4 * at : 4 * (at + size)]
                    row = doc_id, block["start"] + at, size, zlib.crc32(part)
                    out.append((*row, part) if with_ids else row)
                    at += size
                types = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema += ", ids binary" if with_ids else ""
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.read.parquet(f"{path}/blocks").mapInArrow(unpack, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: what is read back of every document."""
    import public_tokenizers

    path = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_store(spark, path, with_ids=False)
