import zlib

import numpy as np
from pyspark.sql import functions as F

from regspan.llm import quality

BASE = "/root/testdata/sf0.01"


def tables(spark):
    return (spark.read.parquet(f"{BASE}/{n}.parquet") for n in ("documents", "labels"))


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.row.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(known[r.row.doc_id], r) for r in rows if r.held_out and r.row.doc_id in known]
    good = np.array([r.score for q, r in held if q == 1])
    bad = np.array([r.score for q, r in held if q == 0])
    assert (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2 > 0.95
    assert np.mean([r.predicted for q, r in held if q == 1]) > 0.98


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = tables(spark)
    held = quality.held_out(F.col("doc_id"))
    changed = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string")})

    def scores(d, x):
        return {r.row.doc_id: r.score for r in quality.classify(d, x).collect()}

    assert scores(docs, labels) == scores(other, changed)


def test_votes_are_exact_neighbours(spark):
    docs, labels = tables(spark)
    rows = docs.join(labels, "doc_id").withColumn("label", F.col("quality").cast("double"))
    model = quality.fit(rows, limit=200)
    assert len(model.labels) == min(200, rows.count())
    texts = [r.text for r in docs.limit(50).collect()]
    got = quality.votes(texts, model)
    for text, score in zip(texts, got):
        v = quality._weighted(quality.term_counts([text]), model.rarity) @ model.directions
        cosines = model.vectors @ (v[0] / np.linalg.norm(v[0]))
        best = np.argsort(-cosines, kind="stable")[: quality.NEIGHBOURS]
        w = np.maximum(cosines[best], 0).astype(float) ** quality.SHARPNESS
        assert abs((w * model.labels[best]).sum() / w.sum() - score) < 0.05


def test_odd_rows(spark, odd, clashing, empty):
    _, labels = tables(spark)
    got = quality.classify(clashing, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(empty, labels).count() == 0
    none = quality.classify(odd, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert next(r for r in got if r.row.doc_id is None).held_out is False
