"""Removal of repeated passages by bucket-pointer refinement over suffixes.

A byte is removed if a string of LENGTH bytes that covers it also starts earlier. Suffixes
need to be told apart to that depth only, and in three rounds:

1. Initial buckets. Suffixes are put into buckets of equal Q-grams. Every window of LENGTH
   bytes is represented by one suffix in it, that of the least bucket identifier, so equal
   windows are represented in the same bucket, and windows next to each other mostly by the
   same suffix. One row stands for such a run of windows.
2. Refinement. Identifiers of longer strings are made from identifiers at later offsets: that
   of 2n bytes from those of n bytes at offsets 0 and n, each round reusing what the round
   before has updated, up to LENGTH. They refine each bucket: rows are sorted by bucket and
   by the identifier of all their windows. Equal rows are repeats of the first. Buckets
   whose rows are all equal are settled.
3. Buckets that still hold different rows differ in some windows only. Those of the first
   row of each kind are sorted one by one, again by identifier.

Identifiers are 64-bit hashes of the bytes they stand for, the same in every task, so no
round needs a join to look them up. Rows pass sorted through a task one batch at a time, so
a bucket may be of any size; repeats within a part of the input are settled before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regspan.llm.common import stored, table

LENGTH = 100
Q = 32
_CHUNK = 1 << 18  # bytes of text worked on at once
_HELD = 1 << 17  # rows in which repeats are settled before the shuffle

_ROWS = "bucket long, ident long, doc_id long, start int, windows int, settled boolean"


def _spread(x):
    import numpy as np

    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _join(a, b):
    """Identifier of a string from those of its parts."""
    import numpy as np

    return _spread(_spread(a) + b * np.uint64(0xBF58476D1CE4E5B9))


def _identifiers(data, length: int, also: int):
    """Identifiers of the strings of `length` and of `also` bytes (a power of 2) at each place."""
    import numpy as np

    ident = _spread(data.astype(np.uint64) + np.uint64(1))
    n, small = 1, None
    while n < length:
        if n == also:
            small = ident
        step = min(n, length - n)
        ident = _join(ident[: len(ident) - step], ident[step:])
        n += step
    return ident, small


def _least(values, width: int):
    """Minimum of `width` values from each place on."""
    import numpy as np

    n = 1
    while n < width:
        step = min(n, width - n)
        values = np.minimum(values[: len(values) - step], values[step:])
        n += step
    return values


def _windows(texts: list[bytes], length: int):
    """Of all windows of the texts: text number, start, identifier, bucket, and whether the
    suffix that represents it starts where it does, so that the next window has another.
    """
    import numpy as np

    sizes = np.array([len(t) for t in texts])
    counts = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    if not len(text):
        empty = np.empty(0, np.uint64)
        return text, text, empty, empty, empty
    data = np.frombuffer(b"".join(texts), np.uint8)
    q = min(Q, length)
    ident, grams = _identifiers(data, length, q)
    grams = ident if grams is None else grams
    buckets = _least(grams, length - q + 1)
    start = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = start + np.repeat(np.cumsum(sizes) - sizes, counts)
    return text, start, ident[place], buckets[place], grams[place] == buckets[place]


def _chunks(ids: list, texts: list) -> Iterator[tuple[list, list[bytes]]]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= _CHUNK or i == len(texts) - 1:
            yield ids[begin : i + 1], [t or b"" for t in texts[begin : i + 1]]
            begin, size = i + 1, 0


def _runs(docs: DataFrame, length: int) -> DataFrame:
    """_ROWS: runs of windows of one bucket. ident stands for all bytes of the run.

    settled: an equal run comes earlier in the same part of the input.
    """

    def find(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: list[tuple] = []

        def settle():
            bucket, ident, doc, start, windows = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.lexsort((start, doc, ident, bucket))
            bucket, ident, doc, start, windows = (
                c[order] for c in (bucket, ident, doc, start, windows)
            )
            same = np.zeros(len(order), bool)
            same[1:] = (bucket[1:] == bucket[:-1]) & (ident[1:] == ident[:-1])
            # What is settled only passes through, so it is dealt out evenly.
            bucket = np.where(same, _join(doc.view(np.uint64), start.astype(np.uint64)), bucket)
            columns = (bucket.view(np.int64), ident.view(np.int64), doc, start, windows, same)
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns],
                ["bucket", "ident", "doc_id", "start", "windows", "settled"],
            )

        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for ids, texts in _chunks(*columns):
                text, start, ident, bucket, at_start = _windows(texts, length)
                if not len(text):
                    continue
                first = np.ones(len(text), bool)
                # Of equal least grams the leftmost represents, so windows of a run differ.
                first[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1]) | at_start[:-1]
                first = np.flatnonzero(first)
                windows = np.diff(first, append=len(text))
                inside = np.arange(len(text), dtype=np.uint64) - np.repeat(first, windows).astype(np.uint64)
                whole = np.add.reduceat(_join(ident, inside), first)
                doc = np.array(ids, np.int64)[text[first]]
                held.append(
                    (bucket[first], whole, doc, start[first].astype(np.int32), windows.astype(np.int32))
                )
                if sum(len(h[0]) for h in held) >= _HELD:
                    yield settle()
        if held:
            yield settle()

    return docs.select("doc_id", "text").mapInArrow(find, _ROWS)


_FOUND = "doc_id long, start int, windows int, is_open boolean"


def _refined(runs: DataFrame) -> DataFrame:
    """_FOUND of rows sorted by bucket, identifier and place.

    Rows that repeat an earlier one, and, as is_open, the first of each kind where a bucket
    holds several kinds.
    """

    def pass_through(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = [c.split()[0] for c in _FOUND.split(", ")]

        def out(doc, start, windows, is_open):
            return pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(start), pa.array(windows), pa.array(is_open)], names
            )

        last = None  # bucket and identifier of the row before
        kept = None  # the last first row: bucket, doc, start, windows, whether it is open
        for batch in batches:
            bucket, ident, doc, start, windows = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)
            )
            settled = batch.column(5).to_numpy(zero_copy_only=False).astype(bool)
            yield out(doc[settled], start[settled], windows[settled], settled[settled] & False)
            rest = np.flatnonzero(~settled)
            if not len(rest):
                continue
            bucket, ident, doc, start, windows = (c[rest] for c in (bucket, ident, doc, start, windows))
            same = np.zeros(len(rest), bool)
            same[1:] = (bucket[1:] == bucket[:-1]) & (ident[1:] == ident[:-1])
            same[0] = last == (bucket[0], ident[0])
            last = bucket[-1], ident[-1]
            yield out(doc[same], start[same], windows[same], np.zeros(int(same.sum()), bool))
            new = [c[~same] for c in (bucket, doc, start, windows)]
            is_open = np.zeros(len(new[0]), bool)
            if kept is not None:
                new = [np.concatenate([[k], c]).astype(c.dtype) for k, c in zip(kept, new)]
                is_open = np.concatenate([[kept[4]], is_open])
            if not len(new[0]):
                continue
            equal = new[0][1:] == new[0][:-1]
            is_open[1:] |= equal
            is_open[:-1] |= equal
            kept = (*(c[-1] for c in new), is_open[-1])
            ready = is_open[:-1]
            yield out(*(c[:-1][ready] for c in new[1:]), ready[ready])
        if kept is not None and kept[4]:
            yield out(*(np.array([k], t) for k, t in zip(kept[1:], (np.int64, np.int32, np.int32, bool))))

    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.repartition(parts, "bucket").sortWithinPartitions("bucket", "ident", "doc_id", "start")
    return dealt.mapInArrow(pass_through, _FOUND)


def _single(opened: DataFrame, length: int) -> DataFrame:
    """_ROWS, one for each window of the open runs: doc_id, text, runs (array of start, windows).

    Windows have no bucket of their own: the identifier is the bucket, so that equal ones meet.
    """

    def find(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for doc_id, text, runs in zip(*(batch.column(i) for i in range(3))):
                _, _, ident, _, _ = _windows([text.as_py()], length)
                starts = np.concatenate(
                    [np.arange(r["start"], min(r["start"] + r["windows"], len(ident))) for r in runs.as_py()]
                ).astype(np.int32)
                key = ident[starts].view(np.int64)
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key), pa.array(np.zeros(n, np.int64)),
                        pa.array(np.full(n, doc_id.as_py(), np.int64)), pa.array(starts),
                        pa.array(np.ones(n, np.int32)), pa.array(np.zeros(n, bool)),
                    ],
                    ["bucket", "ident", "doc_id", "start", "windows", "settled"],
                )

    return opened.mapInArrow(find, _ROWS)


_RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<start:long,end:long>>"
)


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """_RESULT of doc_id, text (binary), runs (array of start, windows, or NULL)."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [
            pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
            pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
        ]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        for batch in batches:
            out = []
            for doc_id, text, runs in zip(*(batch.column(i) for i in range(3))):
                text, spans, kept, at = text.as_py() or b"", [], hashlib.sha256(), 0
                for r in sorted((r["start"], r["windows"]) for r in runs.as_py() or ()):
                    start, end = r[0], min(r[0] + r[1] - 1 + length, len(text))
                    if start >= end:
                        continue
                    if spans and start <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], end))
                    else:
                        spans.append((start, end))
                for start, end in spans:
                    kept.update(text[at:start])
                    at = end
                kept.update(text[at:])
                removed = sum(e - s for s, e in spans)
                out.append(
                    (doc_id.as_py(), len(text), removed, len(spans), kept.hexdigest(),
                     [{"start": s, "end": e} for s, e in spans])
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)], names
            )

    return rows.mapInArrow(cut, _RESULT)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """_RESULT for every row of docs (doc_id, text): spans of bytes to remove, half open.

    Text is taken as UTF-8; NULL is empty. Earlier means smaller doc_id, or the same and an
    earlier start. Rows with NULL doc_id are compared with nothing. Rows that repeat a doc_id
    are one document at one place; should their texts differ, the spans of either are removed
    from both, as far as they reach.
    """
    binary = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    named = binary.where("doc_id IS NOT NULL")
    found = stored(_refined(_runs(named, length)), "suffix-found")

    def by_doc(rows: DataFrame) -> DataFrame:
        run = F.struct("start", "windows")
        return rows.groupBy("doc_id").agg(F.collect_list(run).alias("runs"))

    # Both joins read one shuffle of the texts.
    opened = named.join(by_doc(found.where("is_open")), "doc_id").select("doc_id", "text", "runs")
    single = _refined(_single(opened, length))
    repeats = found.where("NOT is_open").union(single.where("NOT is_open"))
    rows = named.join(by_doc(repeats), "doc_id", "left").select("doc_id", "text", "runs")
    unnamed = binary.where("doc_id IS NULL").select(
        "doc_id", "text", F.lit(None).cast("array<struct<start:int,windows:int>>").alias("runs")
    )
    return _cut(rows.unionByName(unnamed), length)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: what is removed of every document."""
    return repeated_spans(table(spark, sf_dir, "documents")).drop("spans")
