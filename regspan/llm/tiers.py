"""Hierarchical multi-length packing: context-size tiers, gaps of long windows filled from shorter.

A document's ids (and its end id) are cut into full windows of the longest context; each is a
sequence of its own at once. What is left of a document, shorter than a window, is routed to the
tier of the least context size that holds it (128, 256, 512, 1024). Remainders are spread over
step groups by a hash, each group about GROUP_TOKENS ids, one task each. Within a group:

1. every remainder of tiers 256 to 1024 opens a window of its tier at offset 0;
2. remainders of the shortest tier fill the gaps of those windows, longest windows first; the
   longest that fits a gap goes in whole, else one is cut and its rest goes back to the queue;
3. what is left of the shortest tier opens windows of the longest context, filled alike;
4. windows that are not full are merged, longer tiers first, into windows of the longest
   context: the contents of shorter windows fill the gaps of longer ones, cut where needed;
5. the last partial window is cut into sequences whose lengths are the powers of two of its
   length's binary form, longest first.

Every sequence is thus full or a power of two long: there is no padding. Each id lies in exactly
one piece; a piece is a run of one document's ids. Steps groups carry equal numbers of ids up
to the hash's spread and the full windows, which are spread by their own hash.

Odd rows: a NULL or empty text is its end id alone; repeated rows and NULL doc_ids are documents
of their own; extra input columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regspan.llm.common import stored, table
from regspan.llm.tokens import encoder

TIERS = (128, 256, 512, 1024)  # context sizes, shortest first
END_ID = 0
GROUP_TOKENS = 4_000_000  # ids of remainders in one step group, one task
STEP_SALT = 64  # step groups of full windows

_CUT = (
    "doc_key long, no_id boolean, row long, start long, length long, doc_tokens long, "
    "ids binary, sequence_id long, grp long"
)
RESULT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_group long"
)


def cut(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Full windows (with their sequence_id) and remainders (sequence_id NULL) of all documents."""
    window = TIERS[-1]
    end = end_id.to_bytes(4, "little")

    def pieces(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(tokenizer, "keep")
        part = TaskContext.get().partitionId()
        row = windows = 0
        names = [f.split()[0] for f in _CUT.split(", ")]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                 pa.binary(), pa.int64(), pa.int64()]
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text) + end
                total = len(ids) // 4
                key = (part << 32) | row
                for start in range(0, total, window):
                    length = min(window, total - start)
                    sequence = None
                    if length == window:  # unique: the task's number above its own count
                        sequence, windows = (part << 40) | windows, windows + 1
                    out.append((
                        doc_id or 0, doc_id is None, key, start, length, total,
                        ids[4 * start : 4 * (start + length)], sequence, None,
                    ))
                row += 1
            columns = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.select("doc_id", "text").mapInArrow(pieces, _CUT)


def _tier(length: int) -> int:
    return next(t for t in TIERS if t >= length)


def plan(lengths: list[int]) -> list[list[tuple[int, int, int]]]:
    """Sequences of one step group from remainder lengths (each below the longest tier).

    Returns sequences as lists of (remainder index, from, to): the ids [from, to) of that
    remainder, in order of offset.
    """
    longest = TIERS[-1]
    windows: list[tuple[int, list]] = []  # (size, content)
    fillers: dict[int, list[tuple[int, int, int]]] = {n: [] for n in range(1, TIERS[0] + 1)}
    for i, n in sorted(enumerate(lengths), key=lambda x: -x[1]):
        tier = _tier(n)
        if tier == TIERS[0]:
            fillers[n].append((i, 0, n))
        else:
            windows.append((tier, [(i, 0, n)]))
    left = [sum(len(v) for v in fillers.values())]

    def take(gap: int) -> tuple[int, int, int]:
        """The longest filler that fits the gap, else the longest cut to it."""
        for n in range(min(gap, TIERS[0]), 0, -1):
            if fillers[n]:
                left[0] -= 1
                return fillers[n].pop()
        for n in range(TIERS[0], gap, -1):
            if fillers[n]:
                i, a, b = fillers[n].pop()
                fillers[b - a - gap].append((i, a + gap, b))
                return i, a, a + gap
        raise AssertionError("no filler")

    def fill(size: int, content: list) -> int:
        gap = size - sum(b - a for _, a, b in content)
        while gap and left[0]:
            piece = take(gap)
            content.append(piece)
            gap -= piece[2] - piece[1]
        return gap

    windows.sort(key=lambda w: -w[0])
    done, open_ = [], []
    for size, content in windows:
        (open_ if fill(size, content) else done).append(content)
    while left[0]:
        content: list = []
        (open_ if fill(longest, content) else done).append(content)
    # merge what is not full, longer tiers first, into windows of the longest context
    stream = [p for content in open_ for p in content]
    current, used = [], 0
    for i, a, b in stream:
        while a < b:
            step = min(b - a, longest - used)
            current.append((i, a, a + step))
            used, a = used + step, a + step
            if used == longest:
                done.append(current)
                current, used = [], 0
    # the last partial window: one sequence per power of two of its length, longest first
    at = 0
    for bit in reversed(range(longest.bit_length())):
        size = 1 << bit
        if not used & size:
            continue
        part, need = [], size
        while need:
            i, a, b = current[at]
            step = min(b - a, need)
            part.append((i, a, a + step))
            need -= step
            if a + step == b:
                at += 1
            else:
                current[at] = (i, a + step, b)
        done.append(part)
    return done


def _pack_group(group: pd.DataFrame) -> pd.DataFrame:
    """Pieces with sequence_id and offset for the remainders of one step group."""
    grp = int(group["grp"].iloc[0])
    group = group.sort_values("row", kind="stable").reset_index(drop=True)
    sequences = plan(group["length"].tolist())
    rows = []
    ids = group["ids"].tolist()
    for number, content in enumerate(sequences):
        offset = 0
        for i, a, b in content:
            chunk = ids[i][4 * a : 4 * b]
            rows.append((
                int(group["doc_key"].iat[i]), bool(group["no_id"].iat[i]), int(group["start"].iat[i]) + a,
                b - a, zlib.crc32(chunk), int(group["doc_tokens"].iat[i]),
                (1 << 62) | (grp << 31) | number, offset, sum(y - x for _, x, y in content), grp,
            ))
            offset += b - a
    columns = ["doc_key", "no_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
               "used", "step_group"]
    return pd.DataFrame(rows, columns=columns)


_PACKED = (
    "doc_key long, no_id boolean, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, used long, step_group long"
)


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """All documents (doc_id, text) packed into sequences of TIERS; RESULT columns."""
    pieces = stored(cut(docs, tokenizer), "tier-pieces")
    full = pieces.where(F.col("sequence_id").isNotNull()).select(
        F.when(~F.col("no_id"), F.col("doc_key")).alias("doc_id"), "start", "length",
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"),
        F.lit(TIERS[-1]).alias("tier"),
        F.pmod(F.xxhash64("sequence_id"), F.lit(STEP_SALT)).cast("long").alias("step_group"),
    )
    rests = pieces.where(F.col("sequence_id").isNull())
    total = rests.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // GROUP_TOKENS))
    rests = rests.withColumn("grp", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))
    shared = rests.groupBy("grp").applyInPandas(_pack_group, _PACKED).select(
        F.when(~F.col("no_id"), F.col("doc_key")).alias("doc_id"), "start", "length", "ids_crc32",
        "doc_tokens", "sequence_id", "offset",
        F.col("used").cast("int").alias("tier"),  # full or a power of two
        (F.col("step_group") + STEP_SALT).alias("step_group"),
    )
    return full.unionByName(shared)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: the place of every piece."""
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
