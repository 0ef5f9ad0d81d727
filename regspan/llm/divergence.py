"""Source divergence audit: hash-consed segment trees over term ids, priced pair by pair.

For each language the terms held by at least three of its documents are kept and numbered
0..V-1. Every (lang, source) group and every language is a vector of counts over them; a term
gets p = 1 + floor(10**9 (count + 1) / (N + V)), N the group's count over kept terms.

Part `pair` prices a group A against each other source B of its language: the sum over kept
terms of floor((pA - pB)^2 / pB). The term range of a language is cut into blocks; one task
takes one block of one language with the counts of all its groups there. In it, every group's
counts form a segment tree whose nodes are hash-consed: equal count subtrees, of one group or of
several, are one node, and every all-zero subtree of a height is the same node. The two trees of
a pair are walked together; a pair of nodes met again is priced from a memo, and a pair of zero
nodes is priced at once for its whole width. Block sums are added up by Spark.

Part `term` lists a group's kept terms with count > 0 whose p is above the language's p, valued
by floor((p - q)^2 / q) with q the language's p; the 200 highest by value, then UTF-8 term.

Odd rows: NULL text, lang or source read as ''; a group without terms is priced as all zeros;
a language without kept terms gives pair values 0 and no term rows; repeated rows count as
documents of their own; extra input columns are ignored; an empty table gives an empty result.
All arithmetic is exact: Spark decimals and integer division, Python integers in the tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regspan.llm.common import stored, table

# Term: a run of ASCII letters and characters beyond ASCII (fixed by the contract).
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 10**9
LEAF = 64  # term ids under a leaf of a segment tree, priced by numpy at once
BLOCK = 4096  # least term ids of a block; a language has at most BLOCKS blocks beyond that
BLOCKS = 64

RESULT = "lang string, source string, part string, item string, value long, rank int"
_PRICES = "lang string, source string, item string, value long"


def terms(text) -> F.Column:
    """All terms of a text, A-Z lower-cased only; none for NULL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    folded = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    # the pieces between runs of other characters: the same terms, found faster
    return F.array_remove(F.split(folded, SEPARATORS), "")


class Forest:
    """Hash-consed segment trees of one block: equal subtrees are one node, in all groups."""

    def __init__(self, width: int):
        self.height = 0
        while LEAF << self.height < width:
            self.height += 1
        self.width = width
        self.nodes: dict[tuple, int] = {}
        self.kids: list[tuple] = []  # node -> (height, left, right) or (0, counts)
        self.zero = []
        for h in range(self.height + 1):
            self.zero.append(self._intern((0, (0,) * LEAF) if h == 0 else (h, self.zero[-1], self.zero[-1])))

    def _intern(self, key: tuple) -> int:
        node = self.nodes.get(key)
        if node is None:
            node = self.nodes[key] = len(self.kids)
            self.kids.append(key)
        return node

    def tree(self, ids: np.ndarray, counts: np.ndarray) -> int:
        """The root of a group's tree from its nonzero counts by term id within the block."""
        level: dict[int, int] = {}
        chunks = ids // LEAF
        for chunk in np.unique(chunks):
            leaf = [0] * LEAF
            for i, c in zip(ids[chunks == chunk].tolist(), counts[chunks == chunk].tolist()):
                leaf[i % LEAF] = c
            level[int(chunk)] = self._intern((0, tuple(leaf)))
        for h in range(1, self.height + 1):
            up: dict[int, int] = {}
            for parent in {c // 2 for c in level}:
                left = level.get(2 * parent, self.zero[h - 1])
                right = level.get(2 * parent + 1, self.zero[h - 1])
                up[parent] = self._intern((h, left, right))
            level = up
        return level.get(0, self.zero[self.height])


def _price_pairs(entries: pd.DataFrame, groups: pd.DataFrame, width: int) -> pd.DataFrame:
    """Pair values of one block: every group against every other source of its language.

    entries: source, tid (term id within the block), count; groups: source, total (N + V).
    """
    forest = Forest(width)
    sources = groups["source"].tolist()
    totals = dict(zip(sources, (int(t) for t in groups["total"].tolist())))
    roots = {s: forest.zero[forest.height] for s in sources}
    for source, part in entries.groupby("source", sort=False):
        roots[source] = forest.tree(part["tid"].to_numpy(np.int64), part["count"].to_numpy(np.int64))
    p_cache: dict[tuple[int, int], np.ndarray] = {}

    def p_of(leaf: int, total: int) -> np.ndarray:
        found = p_cache.get((leaf, total))
        if found is None:
            counts = forest.kids[leaf][1]
            found = np.array([1 + (SCALE * (c + 1)) // total for c in counts], dtype=np.int64)
            p_cache[(leaf, total)] = found
        return found

    out = []
    for a in sources:
        for b in sources:
            if a == b:
                continue
            ta, tb = totals[a], totals[b]
            memo: dict[tuple[int, int, int], int] = {}
            pa0, pb0 = 1 + SCALE // ta, 1 + SCALE // tb
            zero_price = (pa0 - pb0) * (pa0 - pb0) // pb0

            def price(x: int, y: int, height: int, start: int) -> int:
                valid = min(LEAF << height, forest.width - start)
                if valid <= 0:
                    return 0
                if x == forest.zero[height] and y == forest.zero[height]:
                    return valid * zero_price
                key = (x, y, valid)
                found = memo.get(key)
                if found is not None:
                    return found
                if height == 0:
                    pa, pb = p_of(x, ta)[:valid], p_of(y, tb)[:valid]
                    found = int(((pa - pb) * (pa - pb) // pb).sum())
                else:
                    _, xl, xr = forest.kids[x]
                    _, yl, yr = forest.kids[y]
                    half = LEAF << (height - 1)
                    found = price(xl, yl, height - 1, start) + price(xr, yr, height - 1, start + half)
                memo[key] = found
                return found

            out.append((a, b, price(roots[a], roots[b], forest.height, 0)))
    return pd.DataFrame(out, columns=["source", "item", "value"])


def audit(docs: DataFrame) -> DataFrame:
    """Both parts for documents (text, lang, source); RESULT columns."""
    spark = docs.sparkSession
    # one pass over the texts: every term as an occurrence and each distinct one as a document,
    # combined on the map side per (lang, source, term) and stored
    rows = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        terms(F.col("text")).alias("terms"),
    )
    # all terms, then the distinct ones: a place below the number of terms is an occurrence
    both = F.posexplode(F.concat("terms", F.array_distinct("terms"))).alias("at", "term")
    occurrence = (F.col("at") < F.col("n")).cast("long")
    per_group = stored(
        rows.select("lang", "source", F.size("terms").alias("n"), both)
        .select("lang", "source", "term", occurrence.alias("occ"), (1 - occurrence).alias("doc"))
        .groupBy("lang", "source", "term")
        .agg(F.sum("occ").cast("long").alias("count"), F.sum("doc").cast("long").alias("docs")),
        "div-terms",
    )
    groups = docs.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")
    ).distinct()
    held = (
        per_group.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= MIN_DOCS)
        .select("lang", "term")
    )
    # dense ids within a language, numbered within (lang, salt) and moved by earlier salts
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    held = held.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(salts)))
    sizes = held.groupBy("lang", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("lang").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    moves = sizes.select(
        "lang", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("move"),
        F.sum("n").over(Window.partitionBy("lang")).alias("v"),
    )
    kept = stored(
        held.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy("term")))
        .join(moves, ["lang", "salt"])
        .select("lang", "term", (F.col("at") - 1 + F.col("move")).alias("tid"), "v"),
        "div-kept",
    )
    counts = stored(per_group.select("lang", "source", "term", "count").join(kept, ["lang", "term"]), "div-counts")
    langs = kept.select("lang", "v").distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("count").alias("n_sum"))
    # one row per group, with its language's total too: a small stored table, joined by its size,
    # so that no join of the counts is keyed by the language alone
    lang_sums = sums.groupBy("lang").agg(F.sum("n_sum").alias("lang_sum"))
    v = F.coalesce("v", F.lit(0))
    grouped = (
        groups.join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
        .join(lang_sums, "lang", "left")
        .select(
            "lang", "source", v.alias("v"), (v + F.coalesce("n_sum", F.lit(0))).alias("total"),
            (v + F.coalesce("lang_sum", F.lit(0))).alias("lang_total"),
        )
    )
    grouped = stored(grouped, "div-groups")

    # part pair: blocks of term ids of each language, every group of it in every block
    width = F.greatest(F.lit(BLOCK).cast("long"), F.expr(f"CAST(ceil(v / {BLOCKS}) AS BIGINT)"))
    blocks = (
        langs.withColumn("width", width)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(v - 1) div width"))))
        .withColumn("block_width", F.least("width", F.col("v") - F.col("block") * F.col("width")))
    )
    entries = counts.join(blocks.select("lang", "width").distinct(), "lang").select(
        "lang", (F.col("tid") / F.col("width")).cast("long").alias("block"), "source",
        (F.col("tid") % F.col("width")).alias("tid"), "count",
    )
    members = grouped.where(F.col("v") > 0).join(
        blocks.select("lang", "block", "block_width"), "lang"
    ).select(F.col("lang").alias("g_lang"), F.col("block").alias("g_block"), "block_width", "source", "total")

    def priced(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if right.empty:
            return pd.DataFrame({c: [] for c in ["lang", "source", "item", "value"]})
        out = _price_pairs(left, right, int(right["block_width"].iloc[0]))
        return out.assign(lang=right["g_lang"].iloc[0])[["lang", "source", "item", "value"]]

    block_values = entries.groupBy("lang", "block").cogroup(
        members.groupBy("g_lang", "g_block")
    ).applyInPandas(priced, _PRICES)
    pairs_zero = (
        grouped.where(F.col("v") == 0).alias("a")
        .join(grouped.where(F.col("v") == 0).alias("b"), "lang")
        .where(F.col("a.source") != F.col("b.source"))
        .select("lang", F.col("a.source").alias("source"), F.col("b.source").alias("item"), F.lit(0).cast("long").alias("value"))
    )  # languages without kept terms: a few groups each, their pairs are the result
    pairs = block_values.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    pairs = pairs.unionByName(pairs_zero).withColumn("part", F.lit("pair"))

    # part term: natively, against the language's p
    lang_counts = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"))
    with_p = counts.join(grouped.select("lang", "source", "total", "lang_total"), ["lang", "source"]).join(
        lang_counts, ["lang", "term"]
    ).select(
        "lang", "source", F.col("term").alias("item"),
        F.expr(f"1 + (CAST(count + 1 AS DECIMAL(38,0)) * {SCALE}) div total").alias("p"),
        F.expr(f"1 + (CAST(lang_count + 1 AS DECIMAL(38,0)) * {SCALE}) div lang_total").alias("q"),
    )
    term_rows = with_p.where(F.col("p") > F.col("q")).select(
        "lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"),
        F.lit("term").alias("part"),
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked_terms = term_rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    ranked_pairs = pairs.withColumn("rank", F.row_number().over(order))
    return ranked_pairs.unionByName(ranked_terms).select(
        "lang", "source", "part", "item", F.col("value").cast("long"), F.col("rank").cast("int")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every source of a language against the others and against the language."""
    return audit(table(spark, sf_dir, "documents"))
