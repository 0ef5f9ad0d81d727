"""Near-duplicates by MinHash: banding, signature check, full check, connected components.

1. Every document gives the set of its shingles (64-bit hashes), HASHES universal hash minima
   over it, band keys of ROWS minima, and sketches: one bit per minimum, and the parity of the
   shingles that fall on each of PARITIES bits.
2. Documents with equal sets are one class; only the smallest id of a class goes on.
3. Band keys held by one class only are dropped. The class of a bucket that meets most others
   is its centre. Every class is paired with the most central of its centres first; pairs are
   checked by sketch, then on full sets. Components of the links label the classes.
4. Pairs that share a label need no check, so a large group of near copies never gives its
   square. What else shares a bucket is checked in the same way: members against the centre
   where labels differ, then, with new labels, members against members where labels differ.
5. Components of all links.

A pair at the threshold misses all bands with probability (1 - s**ROWS)**BANDS, 6e-9 for
0.85 and 5e-6 for 0.8 (the pipeline). The check on full sets makes what is found exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspan.llm.components import components
from regspan.llm.common import stored, table

SHINGLE = 5
THRESHOLD = 0.85
ROWS, BANDS = 6, 40
HASHES = ROWS * BANDS
_SKETCH = (HASHES + 63) // 64  # longs
PARITIES = 1024
_SEED = 20240229
_CHUNK = 1 << 20  # bytes of text worked on at once


def _sketch_limit(threshold: float) -> int:
    """Bits of minima that may differ: the mean at the threshold and six standard deviations."""
    p = (1 - threshold) / 2
    return int(HASHES * p + 6 * (HASHES * p * (1 - p)) ** 0.5)


def _mix(x):
    """A bijection of 64-bit numbers that spreads every bit (multiply and shift twice)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(texts: list[str | None]):
    """Distinct shingle hashes of each text, ascending: all in one array, and where each begins.

    Words are lower-cased in A-Z only. Fewer words than SHINGLE count as one shingle.
    """
    import numpy as np

    words = [(t or "").encode().lower().split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(counts.sum()), object)
    flat[:] = [w for doc in words for w in doc]
    codes, distinct = pd.factorize(flat)
    hashes = pd.util.hash_array(distinct, categorize=False) if len(distinct) else np.empty(0, np.uint64)
    h = _mix(hashes)[codes] if len(codes) else np.empty(0, np.uint64)
    begin = np.concatenate([[0], np.cumsum(counts)])
    gram = np.zeros(len(h), np.uint64)
    for i in range(SHINGLE):
        gram[: len(h) - i] += _mix(h[i:] + np.uint64(i + 1))
    gram = _mix(gram)
    place = np.arange(len(h)) - np.repeat(begin[:-1], counts)
    size = np.repeat(counts, counts)
    full = place <= size - SHINGLE
    doc = np.repeat(np.arange(len(texts)), counts)
    keys, owner = gram[full], doc[full]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        extra = [
            sum(int(x) for x in _mix(h[begin[d] : begin[d + 1]] + np.arange(7, 7 + counts[d], dtype=np.uint64)))
            % 2**64
            for d in short
        ]
        keys = np.concatenate([keys, _mix(np.array(extra, np.uint64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[new], owner[new]
    return keys, np.searchsorted(owner, np.arange(len(texts) + 1))


def _chunks(ids: list, texts: list[str | None]) -> Iterator[tuple[list, list]]:
    """Rows of about _CHUNK bytes at a time, so that memory follows the longest text only."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= _CHUNK or i == len(texts) - 1:
            yield ids[start : i + 1], texts[start : i + 1]
            start, size = i + 1, 0


def _signatures(keys, begin, n: int):
    """Band keys (n x BANDS) and sketches (n x _SKETCH) of sets that are not empty."""
    import numpy as np

    random = np.random.default_rng(_SEED)
    a = random.integers(0, 2**64, HASHES, np.uint64) | np.uint64(1)
    b = random.integers(0, 2**64, HASHES, np.uint64)
    x = keys >> np.uint64(32)
    minima = np.empty((HASHES, n), np.uint64)
    for j in range(HASHES):  # multiply-shift: universal on 32-bit numbers
        minima[j] = np.minimum.reduceat((x * a[j] + b[j]) >> np.uint64(32), begin)
    bands = np.zeros((BANDS, n), np.uint64)
    for r in range(ROWS):
        bands = _mix(bands + minima[r::ROWS] + np.uint64(1))
    bands = _mix(bands + np.arange(BANDS, dtype=np.uint64)[:, None])
    bits = np.zeros((_SKETCH * 64, n), np.uint8)
    bits[:HASHES] = _mix(minima + np.arange(HASHES, dtype=np.uint64)[:, None]) & np.uint64(1)
    sketch = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<i8")
    return bands.T.view(np.int64), sketch


def _parities(keys, begin, n: int):
    """Of each set, for every bit whether an odd number of its shingles falls on it (n x longs).

    A shingle that only one of two sets holds changes one bit, so two sets differ in as many
    shingles as bits at least.
    """
    import numpy as np

    bit = (_mix(keys ^ np.uint64(0x3333333333333333)) >> np.uint64(32)) % np.uint64(PARITIES)
    owner = np.repeat(np.arange(n), np.diff(begin, append=len(keys)))
    counts = np.bincount(owner * PARITIES + bit.astype(np.int64), minlength=n * PARITIES)
    odd = (counts & 1).astype(np.uint8).reshape(n, PARITIES)
    return np.packbits(odd, axis=1, bitorder="little").view("<i8")


_SIGNED = (
    "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>, "
    "odd array<long>"
)


def signed(docs: DataFrame) -> DataFrame:
    """_SIGNED for every row of docs (doc_id, text). set_a and set_b identify the set."""

    def sign(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def lists(m):
            n, k = m.shape
            return pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(m.reshape(-1))
            )

        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for ids, texts in _chunks(*columns):
                keys, begin = shingle_hashes(texts)
                sizes = np.diff(begin)
                some = np.flatnonzero(sizes)
                sums = np.zeros((2, len(ids)), np.uint64)
                bands = np.zeros((len(ids), BANDS), np.int64)
                sketch = np.zeros((len(ids), _SKETCH), np.int64)
                odd = np.zeros((len(ids), PARITIES // 64), np.int64)
                if len(some):
                    at = begin[:-1][some]
                    sums[0, some] = np.add.reduceat(_mix(keys + np.uint64(11)), at)
                    sums[1, some] = np.add.reduceat(_mix(keys ^ np.uint64(0x5555555555555555)), at)
                    bands[some], sketch[some] = _signatures(keys, at, len(some))
                    odd[some] = _parities(keys, at, len(some))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        lists(bands),
                        lists(sketch),
                        lists(odd),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch", "odd"],
                )

    return docs.select("doc_id", "text").mapInArrow(sign, _SIGNED)


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles): the sorted hashes as binary, for documents whose pairs are checked."""

    def collect(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for ids, texts in _chunks(*columns):
                keys, begin = shingle_hashes(texts)
                sets = [keys[s:e].tobytes() for s, e in zip(begin, begin[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sets, pa.binary())],
                    ["doc_id", "shingles"],
                )

    return docs.select("doc_id", "text").mapInArrow(collect, "doc_id long, shingles binary")


def _differing(a: Column, b: Column, longs: int) -> Column:
    pairs = ((F.element_at(a, i + 1), F.element_at(b, i + 1)) for i in range(longs))
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in pairs), F.lit(0))


def _similar(a: Column, b: Column, threshold: float) -> Column:
    """Whether sizes and sketches leave a link possible; a, b: structs n_shingles, sketch, odd.

    Sets of n and m shingles that are similar enough differ in (1 - t) / (1 + t) of n + m
    shingles at most. That and the sizes exclude no link; the minima may, with probability 1e-7.
    """
    n, m = a["n_shingles"], b["n_shingles"]
    apart = (1 - threshold) / (1 + threshold) * (n + m) + 1e-6
    return (
        (F.least(n, m) >= threshold * F.greatest(n, m) - 1e-9)
        & (_differing(a["odd"], b["odd"], PARITIES // 64) <= apart)
        & (_differing(a["sketch"], b["sketch"], _SKETCH) <= _sketch_limit(threshold))
    )


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough: percent of the union at least."""
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    sets = stored(_sets(texts.join(wanted, "doc_id", "left_semi")), "near-sets")
    sets = sets.dropDuplicates(["doc_id"])

    @F.pandas_udf("boolean")
    def enough(a: pd.Series, b: pd.Series) -> pd.Series:
        import numpy as np

        def one(x: bytes, y: bytes) -> bool:
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * common >= percent * (len(x) + len(y) - common)

        return pd.Series(map(one, a, b), dtype=bool)

    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(left, "u").join(right, "v").where(enough("a", "b")).select("u", "v")


def _members(reps: DataFrame) -> DataFrame:
    """Stored (key, doc_id, center, center_weight) of the buckets with two members or more.

    The centre is the member that meets most others in all its buckets: the text of which
    the others are copies, whatever its id.
    """
    keyed = reps.select(F.explode("bands").alias("key"), "doc_id")
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Merged, as the keyed rows are many whatever the size of the other side.
    members = stored(keyed.join(buckets.hint("merge"), "key"), "near-members")
    weights = members.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    most = F.max(F.struct("weight", (-F.col("doc_id")).alias("c"))).alias("m")
    centers = members.join(weights, "doc_id").groupBy("key").agg(most).select(
        "key", (-F.col("m.c")).alias("center"), F.col("m.weight").alias("center_weight")
    )
    return stored(members.select("key", "doc_id").join(centers, "key"), "near-centres")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text).

    component_id is the smallest doc_id reached over links of Jaccard similarity `threshold`
    or more, kept whether that is the row's own. Rows without words are linked with nothing.
    Rows that share a doc_id are taken for one document. Rows with NULL doc_id are not
    linked, their component_id is NULL and they are kept.
    """
    percent = round(100 * threshold)
    every = stored(signed(docs), "near-signed")
    known = every.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = known.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "near-classes")
    reps = known.join(
        classes.select("set_a", "set_b", F.col("rep").alias("doc_id")), ["set_a", "set_b", "doc_id"]
    ).dropDuplicates(["doc_id", "set_a", "set_b"])
    reps = stored(
        reps.select("doc_id", "bands", F.struct("n_shingles", "sketch", "odd").alias("about")), "near-reps"
    )
    about = reps.select("doc_id", "about")
    members = _members(reps)
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    no_roots = docs.sparkSession.createDataFrame([], "node long, root long")

    def joined(roots: DataFrame, pairs: DataFrame) -> DataFrame:
        """Roots after the links among pairs (u, v) are added: checked on full sets."""
        pairs = stored(pairs.distinct(), "near-pairs")
        if pairs.isEmpty():
            return roots
        links = stored(_verified(pairs, texts, percent), "near-links")
        old = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
        return components(old.union(links))

    def likely(pairs: DataFrame) -> DataFrame:
        left = about.select(F.col("doc_id").alias("u"), F.col("about").alias("x"))
        right = about.select(F.col("doc_id").alias("v"), F.col("about").alias("y"))
        both = pairs.distinct().join(left, "u").join(right, "v")
        return both.where(_similar(F.col("x"), F.col("y"), threshold)).select("u", "v")

    def with_labels(roots: DataFrame) -> DataFrame:
        """Members other than centres, with their label and that of the centre."""
        of_center = roots.select(F.col("node").alias("center"), F.col("root").alias("center_root"))
        return (
            members.where("doc_id <> center")
            .join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .join(of_center, "center", "left")
            .select(
                "key", "doc_id", "center",
                F.coalesce("root", "doc_id").alias("label"),
                F.coalesce("center_root", "center").alias("center_label"),
            )
        )

    # One centre a document, the most central it meets: this links nearly all of a large group.
    best = F.max(F.struct("center_weight", (-F.col("center")).alias("c")))
    first = members.where("doc_id <> center").groupBy(F.col("doc_id").alias("v")).agg(best.alias("b"))
    roots = joined(no_roots, likely(first.select((-F.col("b.c")).alias("u"), "v")))
    # The centres of all its buckets, where the label is another.
    star = with_labels(roots).where("label <> center_label")
    roots = joined(roots, likely(star.select(F.col("center").alias("u"), F.col("doc_id").alias("v"))))
    # Every pair of a bucket with its centre is tested by now. What is left are pairs of other
    # members, where they have several labels.
    labelled = stored(with_labels(roots), "near-labelled")
    open_keys = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .where("least <> most")
        .select("key")
    )
    rest = stored(labelled.join(open_keys, "key").join(about, "doc_id"), "near-open")
    x, y = rest.alias("x"), rest.alias("y")
    across = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.label") < F.col("y.label"))
        & _similar(F.col("x.about"), F.col("y.about"), threshold),
    )
    roots = joined(roots, across.select(F.col("x.doc_id").alias("u"), F.col("y.doc_id").alias("v")))

    by_class = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("root", "rep").alias("component_id")
    )
    found = every.select("doc_id", "n_shingles", "set_a", "set_b").join(
        by_class, ["set_a", "set_b", "n_shingles"], "left"
    )
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
    ).alias("component_id")
    return found.select("doc_id", "n_shingles", component).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Input rows of the documents that stand for their component.

    Of rows with equal doc_id, all stay or go.
    """
    kept = near_duplicates(docs, threshold).where("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
