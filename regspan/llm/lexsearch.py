"""Ranked lexical search: exact sparse ball-tree inner-product search, best first.

A document is a sparse vector of integer term scores, a query a sparse vector of integer term
weights; the score of a document is their inner product. Documents are cut into groups by a
hash of the row. Each group meets each block of queries in one task (a stated query set against
all rows, in blocks). There a ball tree is built over the group's vectors, restricted to the
terms of the block: every node keeps its centroid and radius. For a query the inner product of
any document under a node is at most q.c + |q| r. Nodes are opened best first by that bound,
widened by a relative margin above the rounding error of the float operations; a node is left
when its bound is below the query's tenth best score so far. Leaves are scored exactly in 64-bit
integers. Every group's ten best per query are merged by a window over the query.

Scores (fixed by the contract): N documents with a term, L all their terms, n a document's
terms, df, tf; w = floor(1000 ln((2N+2)/(2df+1))) in doubles; m = 10 + (90 n N) div L;
score = sum over the query's distinct terms of w * ((10**9 tf) div (1000 tf + 8 m)).

Odd rows: a NULL or empty text has no terms and is never found; rows with equal doc_id are
documents of their own (equal scores, ties by doc_id, NULL last, and give equal rows); items of
equal item_id, NULL included, are one item with the terms of all; an item without terms or
whose terms no document holds gets no rows; extra input columns are ignored; an empty table of
documents or items gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regspan.llm.common import stored, table

# Term: a run of ASCII letters and digits and any characters beyond ASCII (fixed by the contract).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
GROUP_ENTRIES = 300_000  # (document, term) entries of one group: its tree stays near 100 MB
QUERY_BLOCK = 4096  # queries that meet one group in one task
LEAF = 32  # documents of a leaf
MARGIN = 1e-9  # relative widening of every float bound; rounding error stays below 1e-12

HITS = "item_key long, no_item boolean, doc_key long, no_id boolean, row_key long, score long"


def terms(text) -> F.Column:
    """All terms of a text, A-Z lower-cased only; none for NULL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    folded = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.regexp_extract_all(folded, F.lit(TERM), 0)


class BallTree:
    """A ball tree over the rows of a sparse nonnegative matrix (CSR arrays, no empty row)."""

    def __init__(self, indptr, idx, val, dims):
        n = len(indptr) - 1
        self.dims = dims
        self.order = np.arange(n)
        # nodes: (lo, hi, left, right, centroid terms, centroid values, radius)
        self.nodes: list[tuple] = []
        self._rows = np.repeat(np.arange(n), np.diff(indptr))
        self._indptr, self._idx, self._val = indptr, idx, val
        self._norm2 = np.bincount(self._rows, weights=val * val, minlength=n)
        self._dense = np.zeros(dims)
        self._build()

    def _entries(self, rows):
        starts, counts = self._indptr[rows], np.diff(self._indptr)[rows]
        offsets = np.repeat(starts - np.cumsum(counts) + counts, counts)
        return offsets + np.arange(counts.sum()), np.repeat(np.arange(len(rows)), counts)

    def _dots(self, rows, e, owner, terms_, values):
        """Inner products of the rows with a sparse vector."""
        self._dense[terms_] = values
        out = np.bincount(owner, weights=self._val[e] * self._dense[self._idx[e]], minlength=len(rows))
        self._dense[terms_] = 0.0
        return out

    def _build(self):
        stack = [(0, len(self.order), None)]
        while stack:
            lo, hi, parent = stack.pop()
            rows = self.order[lo:hi]
            e, owner = self._entries(rows)
            cterms, inverse = np.unique(self._idx[e], return_inverse=True)
            cterms = cterms.astype(np.int32)
            cvals = np.bincount(inverse, weights=self._val[e]) / len(rows)
            cnorm2 = float(cvals @ cvals)
            dots = self._dots(rows, e, owner, cterms, cvals)
            dist2 = np.maximum(self._norm2[rows] - 2 * dots + cnorm2, 0.0)
            # cancellation in |x|^2 - 2 x.c + |c|^2 is below 1e-12 of the larger terms
            slack = 1e-12 * (self._norm2[rows].max() + cnorm2)
            radius = float(np.sqrt(dist2.max() + slack))
            me = len(self.nodes)
            self.nodes.append([lo, hi, -1, -1, cterms, cvals, radius])
            if parent is not None:
                self.nodes[parent[0]][2 + parent[1]] = me
            if hi - lo <= LEAF or radius == 0.0:
                continue
            far = rows[int(np.argmax(dist2))]
            fe = np.arange(self._indptr[far], self._indptr[far + 1])
            to_a = self._norm2[rows] - 2 * self._dots(rows, e, owner, self._idx[fe], self._val[fe])
            other = rows[int(np.argmax(to_a))]
            oe = np.arange(self._indptr[other], self._indptr[other + 1])
            to_b = self._norm2[rows] - 2 * self._dots(rows, e, owner, self._idx[oe], self._val[oe])
            side = (to_a + self._norm2[far]) > (to_b + self._norm2[other])
            if side.all() or not side.any():
                side = np.arange(len(rows)) >= len(rows) // 2
            self.order[lo:hi] = np.concatenate([rows[~side], rows[side]])
            cut = lo + int((~side).sum())
            stack.append((cut, hi, (me, 1)))
            stack.append((lo, cut, (me, 0)))

    def search(self, q_terms, q_weights, score_rows, top=TOP):
        """The best `top` rows with score > 0 as (score, row), best first, ties by row.

        score_rows(rows, q_terms, q_weights) gives exact integer scores.
        """
        qf = q_weights.astype(float)
        qnorm = float(np.sqrt(qf @ qf))
        self._dense[q_terms] = qf
        best: list[tuple[int, int]] = []  # heap of (score, -row): the worst on top

        def bound(node):
            cterms, cvals, radius = node[4], node[5], node[6]
            return (float(cvals @ self._dense[cterms]) + qnorm * radius) * (1 + MARGIN)

        try:
            frontier = [(-bound(self.nodes[0]), 0)]
            while frontier:
                negative, at = heapq.heappop(frontier)
                if -negative <= 0 or (len(best) == top and -negative < best[0][0]):
                    break
                node = self.nodes[at]
                if node[2] < 0:
                    rows = self.order[node[0] : node[1]]
                    for s, r in zip(score_rows(rows, q_terms, q_weights).tolist(), rows.tolist()):
                        if s > 0 and (len(best) < top or (s, -r) > best[0]):
                            if len(best) == top:
                                heapq.heapreplace(best, (s, -r))
                            else:
                                heapq.heappush(best, (s, -r))
                    continue
                for child in node[2:4]:
                    heapq.heappush(frontier, (-bound(self.nodes[child]), child))
        finally:
            self._dense[q_terms] = 0.0
        return sorted(((s, -r) for s, r in best), key=lambda x: (-x[0], x[1]))


def _search_group(docs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """One group of documents against one block of queries: the group's ten best per query.

    docs: row_key, doc_key (doc_id, 0 if NULL), no_id, term, s (a row per document and
    query term); queries: item_key, no_item (as doc_key, no_id), term, w.
    """
    names = ["item_key", "no_item", "doc_key", "no_id", "row_key", "score"]
    empty = pd.DataFrame({n: pd.Series([], dtype="bool" if n.startswith("no_") else "int64") for n in names})
    if docs.empty or queries.empty:
        return empty
    vocab = pd.Index(pd.unique(queries["term"]))
    docs = docs.sort_values(["no_id", "doc_key", "row_key"], kind="stable")
    keys, first = np.unique(docs["row_key"].to_numpy(), return_index=True)
    # documents in (doc_id NULLS LAST, row_key) order, so that the row number breaks ties
    order = np.argsort(first, kind="stable")
    position = np.empty(len(keys), dtype=np.int64)
    position[order] = np.arange(len(keys))
    row_of = position[np.searchsorted(keys, docs["row_key"].to_numpy())]
    sort = np.argsort(row_of, kind="stable")
    row_of = row_of[sort]
    idx = vocab.get_indexer(docs["term"].to_numpy()[sort]).astype(np.int32)
    s = docs["s"].to_numpy(np.int64)[sort]
    indptr = np.searchsorted(row_of, np.arange(len(keys) + 1))
    doc_ids = docs["doc_key"].to_numpy()[sort][indptr[:-1]]
    no_ids = docs["no_id"].to_numpy()[sort][indptr[:-1]]
    row_keys = docs["row_key"].to_numpy()[sort][indptr[:-1]]
    tree = BallTree(indptr, idx, s.astype(float), len(vocab))
    dense = np.zeros(len(vocab), dtype=np.int64)

    def score_rows(rows, q_terms, q_weights):
        e, owner = tree._entries(rows)
        dense[q_terms] = q_weights
        products = s[e] * dense[idx[e]]
        dense[q_terms] = 0
        out = np.zeros(len(rows), dtype=np.int64)
        np.add.at(out, owner, products)
        return out

    out = []
    for (item, no_item), q in queries.groupby(["item_key", "no_item"], sort=False):
        q_terms = vocab.get_indexer(q["term"].to_numpy())
        for score, row in tree.search(q_terms, q["w"].to_numpy(np.int64), score_rows):
            out.append((item, no_item, doc_ids[row], no_ids[row], row_keys[row], score))
    if not out:
        return empty
    return pd.DataFrame(out, columns=names)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """For each item (item_id, text) the `top` documents (doc_id, text) of highest score > 0.

    Returns item_id, rank (from 1), doc_id, score.
    """
    spark = docs.sparkSession
    n_items = items.select("item_id").distinct().count()
    blocks = max(1, -(-n_items // QUERY_BLOCK))
    asked = stored(
        items.select(
            F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block"),
            F.coalesce("item_id", F.lit(0)).alias("item_key"), F.col("item_id").isNull().alias("no_item"),
            F.explode(F.array_distinct(terms(F.col("text")))).alias("term"),
        ).distinct(),
        "lex-asked",
    )
    # occurrences of asked terms only; one document may hold a term many times. '' is no term:
    # it marks the one row per document that N and L are taken from, so the texts are read once
    wanted = asked.select("term").union(spark.range(1).select(F.lit(""))).distinct()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_key"), "doc_id", terms(F.col("text")).alias("terms")
    )
    tf = (
        rows.select(
            "row_key", "doc_id", F.size("terms").cast("long").alias("n"),
            F.explode(F.concat(F.array(F.lit("")), "terms")).alias("term"),
        )
        .join(wanted, "term", "left_semi")
        .groupBy("row_key", "doc_id", "n", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    tf = stored(tf, "lex-tf")
    is_doc = F.col("term") == ""
    totals = tf.agg(
        F.count(F.when(is_doc & (F.col("n") > 0), 1)).alias("N"),
        F.sum(F.when(is_doc, F.col("n"))).alias("L"),
        F.count(F.when(~is_doc, 1)).alias("entries"),
    ).first()
    big_n, big_l, n_entries = int(totals["N"]), int(totals["L"] or 0), int(totals["entries"])
    if big_n == 0:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    tf = tf.where(~is_doc)
    m = f"(10L + (90L * n * {big_n}L) div {big_l}L)"
    entries = tf.select(
        "row_key", "doc_id", "term", F.expr(f"(1000000000L * tf) div (1000L * tf + 8L * {m})").alias("s")
    )
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(
        F.lit(1000.0) * F.log((F.lit(2.0 * big_n + 2.0)) / (F.col("df") * 2.0 + 1.0))
    ).cast("long")
    queries = asked.join(df, "term").select("block", "item_key", "no_item", "term", weight.alias("w"))
    groups = max(1, -(-n_entries // GROUP_ENTRIES))
    # every (document, term) entry goes to the blocks whose queries hold the term
    at = entries.join(asked.select("block", "term").distinct(), "term").withColumn(
        "grp", F.pmod(F.xxhash64("row_key"), F.lit(groups))
    )
    at = at.select(
        "block", "grp", "row_key", F.coalesce("doc_id", F.lit(0)).alias("doc_key"),
        F.col("doc_id").isNull().alias("no_id"), "term", "s",
    )
    # the block of queries is copied to every group; names of their own keep the sides apart
    # both sides of a cogroup need keys of one type: an int and a long of equal value are dealt
    # to different partitions
    last_group = F.lit(groups - 1).cast("long")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), last_group)).alias("q_grp")
    qs = queries.select(F.col("block").alias("q_block"), copies, "item_key", "no_item", "term", "w")
    hits = at.groupBy("block", "grp").cogroup(qs.groupBy("q_block", "q_grp")).applyInPandas(
        lambda d, q: _search_group(d, q), HITS
    )
    # rows of equal doc_id and score give equal output rows, so row_key settles the rest
    ranked = Window.partitionBy("no_item", "item_key").orderBy(F.desc("score"), "no_id", "doc_key", "row_key")
    return (
        hits.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top)
        .select(
            F.when(~F.col("no_item"), F.col("item_key")).alias("item_id"), F.col("rank").cast("int"),
            F.when(~F.col("no_id"), F.col("doc_key")).alias("doc_id"), "score",
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op11: each benchmark item's ten best documents."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
