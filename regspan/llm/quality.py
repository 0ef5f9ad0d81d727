"""Quality scores by nearest labelled neighbours in a latent-semantic space.

Terms of a text are its words and pairs of bytes, hashed, and a few signs of form. Weighted by
logarithm and rarity they are projected on the main directions of the labelled texts
(truncated singular value decomposition). Labelled vectors, at most LABELLED of them, are
broadcast; every document gets exact cosines to all of them, in blocks, and the labels of
the NEIGHBOURS most similar vote with weights that grow with similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspan.llm.common import row_and, table

LABELLED = 4096  # bound of the sample that is fitted and broadcast: smallest hashes of ids
DIRECTIONS = 64
NEIGHBOURS = 15
SHARPNESS = 8  # power of the cosine by which a neighbour counts
PREDICT = 0.7
_PAIRS, _WORDS, _SIGNS = 2048, 2048, 8
TERMS = _PAIRS + _WORDS + _SIGNS
_BLOCK = 256  # documents
_CHUNK = 1 << 20  # bytes


class Model(NamedTuple):
    rarity: np.ndarray  # TERMS
    directions: np.ndarray  # TERMS x DIRECTIONS
    vectors: np.ndarray  # labelled x DIRECTIONS
    labels: np.ndarray
    prior: float


def term_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of the terms of each text."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for row, text in zip(out, texts):
        data = (text or "").encode()
        if len(data) > 1:
            b = np.frombuffer(data, np.uint8).astype(np.uint32)
            pair = (b[:-1] * np.uint32(256) + b[1:]) * np.uint32(40503) & np.uint32(0xFFFF)
            row[:_PAIRS] = np.bincount(pair >> np.uint32(5), minlength=_PAIRS)
        words = data.split()
        if not words:
            continue
        codes, distinct = pd.factorize(np.array(words, object))
        hashes = pd.util.hash_array(distinct, categorize=False) >> np.uint64(53)
        times = np.bincount(codes)
        row[_PAIRS : _PAIRS + _WORDS] = np.bincount(hashes, weights=times, minlength=_WORDS)
        lines = [x for x in data.split(b"\n") if x.strip()]
        signs = row[_PAIRS + _WORDS :]
        signs[0] = np.count_nonzero(codes[1:] == codes[:-1])
        signs[1] = len(words) * (len(lines) - len(set(lines))) / max(1, len(lines))
        signs[2] = sum(int(times[i]) for i, w in enumerate(distinct) if w.isupper() and len(w) > 2)
        signs[3] = sum(int(times[i]) for i, w in enumerate(distinct) if not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,")
        signs[4] = sum(int(times[i]) for i, w in enumerate(distinct) if len(w) == 1 and not w.isalnum())
        signs[5] = sum(int(times[i]) for i, w in enumerate(distinct) if w.isdigit())
        windows = codes[: len(codes) // 5 * 5].reshape(-1, 5)
        signs[6] = 5 * (len(windows) - len(np.unique(windows, axis=0))) if len(windows) else 0
    return out


def _weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * rarity
    norms = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(norms > 0, norms, 1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def _main_directions(a: np.ndarray, k: int) -> np.ndarray:
    """Right singular vectors of the k largest singular values, by subspace iteration."""
    k = min(k, *a.shape)
    random = np.random.default_rng(7)
    y = a @ random.standard_normal((a.shape[1], min(k + 16, a.shape[1])), dtype=np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(y)
        y = a @ (a.T @ q)
    q, _ = np.linalg.qr(y)
    return np.ascontiguousarray(np.linalg.svd(q.T @ a, full_matrices=False)[2][:k].T)


def _blocks(texts: list) -> Iterator[list]:
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= _CHUNK or i + 1 - begin >= _BLOCK or i == len(texts) - 1:
            yield texts[begin : i + 1]
            begin, size = i + 1, 0


def fit(labelled: DataFrame, limit: int = LABELLED) -> Model:
    """Model of labelled rows (doc_id, text, label between 0 and 1).

    Of more than `limit` rows those of the smallest hashes of doc_id are taken. Their terms,
    in sparse form, come to the driver: a few kB a row at most.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            labels = batch.column(1).to_pylist()
            at = 0
            for texts in _blocks(batch.column(0).to_pylist()):
                counts = term_counts(texts)
                used = [np.flatnonzero(c) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(labels[at : at + len(texts)], pa.float64()),
                        pa.array([u.astype("<u2").tobytes() for u in used], pa.binary()),
                        pa.array([c[u].tobytes() for c, u in zip(counts, used)], pa.binary()),
                    ],
                    ["label", "places", "counts"],
                )
                at += len(texts)

    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = chosen.select("text", F.col("label").cast("double")).mapInArrow(
        count, "label double, places binary, counts binary"
    ).collect()
    counts = np.zeros((len(rows), TERMS), np.float32)
    for row, found in zip(counts, rows):
        row[np.frombuffer(found["places"], "<u2")] = np.frombuffer(found["counts"], np.float32)
    labels = np.array([r["label"] for r in rows], np.float64)
    rarity = np.log((1 + len(rows)) / (1 + np.count_nonzero(counts, axis=0))).astype(np.float32) + 0.1
    weighted = _weighted(counts, rarity)
    directions = _main_directions(weighted, DIRECTIONS) if len(rows) else np.zeros((TERMS, 1), np.float32)
    prior = float(labels.mean()) if len(rows) else 0.5
    return Model(rarity, directions, _unit(weighted @ directions), labels, prior)


def votes(texts: list[str | None], model: Model) -> np.ndarray:
    """Score of each text: the weighted share of label 1 among its neighbours.

    A text without terms, or without any similar neighbour, gets the share in all labels.
    """
    vectors = _unit(_weighted(term_counts(texts), model.rarity) @ model.directions)
    if not len(model.labels):
        return np.full(len(texts), model.prior)
    cosines = vectors @ model.vectors.T
    k = min(NEIGHBOURS, cosines.shape[1])
    best = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weights = np.maximum(np.take_along_axis(cosines, best, 1), 0).astype(np.float64) ** SHARPNESS
    sums = weights.sum(axis=1)
    share = (weights * model.labels[best]).sum(axis=1) / np.where(sums > 0, sums, 1)
    return np.clip(np.where(sums > 0, share, model.prior), 0, 1)


def scored(text: Column, model: Model, spark) -> Column:
    """Score column; NULL counts as an empty text."""
    sent = spark.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Model(*sent.value)
        for texts in batches:
            found = [votes(block, known) for block in _blocks(texts.tolist())]
            yield pd.Series(np.concatenate(found) if found else np.empty(0))

    return score(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Input rows of docs (doc_id, text) as struct `row`, with held_out, score, predicted.

    labels: doc_id, quality (0 or 1; others and NULL are left out; of several labels of a document
    the mean counts). Held-out documents are never learned from. Rows with NULL doc_id are
    scored only.
    """
    spark = docs.sparkSession
    known = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("label"))
    )
    # Chosen before the join, so that few texts meet their labels.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    texts = docs.select("doc_id", "text")
    model = fit(texts.join(F.broadcast(chosen), "doc_id"))  # LABELLED rows at most
    found = row_and(docs, held_out=held_out(docs["doc_id"]), score=scored(docs["text"], model, spark))
    return found.withColumn("predicted", (F.col("score") >= PREDICT).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: score of every document."""
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted")
