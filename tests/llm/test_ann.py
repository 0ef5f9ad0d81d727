import numpy as np
from pyspark.sql import functions as F

from regspan.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    good = [
        (i, np.array(v, np.float64)) for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    out = {}
    for i, v in good:
        if i % every == 0:
            scores = [
                (-float(ann.exact_scores(v[None], w[None])[0]), j) for j, w in good
                if j != i and len(w) == len(v)
            ]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return {i: v for i, v in out.items() if v}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def run(spark, rows, k=ann.K, every=5):
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    return found(ann.nearest(table, F.col("vec_id") % every == 0, k))


def as_floats(v):
    return [float(np.float32(x)) for x in v]


def test_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = found(ann.query(spark, sf_dir))
    assert got == brute(rows, 20, 20)


def test_ties_repeats_and_bad_vectors(spark):
    random = np.random.default_rng(3)
    rows = [(i, as_floats(random.standard_normal(8))) for i in range(60)]
    rows += [(100 + i, rows[10][1]) for i in range(70)]  # more ties than places
    rows += [
        (200, None), (205, [0.0] * 8), (210, [1.0, None] + [1.0] * 6), (215, [float("nan")] * 8),
        (220, [float("inf")] + [1.0] * 7), (225, []), (None, rows[3][1]), (230, [1.0, 2.0]),
        (231, [2.0, 1.0]), (235, as_floats(random.standard_normal(8) * 1e-30)),
        (240, as_floats(random.standard_normal(8) * 1e30)),
    ]
    assert run(spark, rows) == brute(rows, 20, 5)


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", 11)
    random = np.random.default_rng(4)
    rows = [(i, as_floats(random.standard_normal(16))) for i in range(150)]
    assert run(spark, rows, k=5) == brute(rows, 5, 5)


def test_few_and_no_rows(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == {0: [(1, 2.0)]}
    assert run(spark, []) == {} and run(spark, [(0, [1.0])]) == {}
