"""Secret scans (DataFrame functions only): fixed patterns, and entropy of candidate strings.

A candidate is a long run of key characters with letters and digits, outside what the fixed
patterns match. Over a window sliding
along it the Shannon entropy of its characters is kept by incremental counts: each step takes
one character out and puts one in. Windows of random hex or base64 text reach entropies that
words seldom do; which ones depends on the size of their alphabet. Known harmless shapes are suppressed by an allow list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regspan.llm.common import row_and, table

# Kinds in the order of the contract; every letter in either case is spelled out.
KINDS = ("assign", "access", "hex", "entropy")
_NAMES = ("password", "passwd", "secret", "token")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


ASSIGN = (
    "(" + "|".join([*map(_either, _NAMES), _either("api") + "_?" + _either("key")]) + ")"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"

WINDOW = 20
# Bits a character: least entropy of a window to report, by alphabet. Of random keys of 20
# characters with a letter and a digit 1 % at most stay below the limit of their alphabet, of
# longer ones fewer. KEY_BITS is for pieces with marks that are not of all three kinds (A-Z, a-z, 0-9).
HEX_BITS, BASE32_BITS, ONE_CASE_BITS, MIXED_BITS, BASE64_BITS, KEY_BITS = 2.9, 3.3, 3.4, 3.64, 3.64, 3.9
ALPHABETS = (
    ("^[0-9A-Fa-f]+$", HEX_BITS),
    ("^([A-Z2-7]+|[a-z2-7]+)$", BASE32_BITS),
    ("^([A-Z0-9]+|[a-z0-9]+)$", ONE_CASE_BITS),
    ("^[A-Za-z0-9]+$", MIXED_BITS),
    ("^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])", BASE64_BITS),
)
RUN = "[A-Za-z0-9]{20,}"
# Shapes that are not secrets: unique ids with dashes, alphabets, placeholders, dates in names.
ALLOWED = (
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
    "|[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]"
    "|[Dd][Uu][Mm][Mm][Yy]|abcdefghijkl|ABCDEFGHIJKL|0123456789|^[A-Za-z]+([-_/=+]+[A-Za-z0-9]{1,12})*$"
)


def _found(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches of a pattern, and the pieces between them (one more)."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """array<struct<start, kind, end, match>> of all matches, in code points.

    A match starts where the pieces and matches before it end.
    """
    matches, pieces = _found(text, pattern)
    order = KINDS.index(kind)
    empty = F.lit([]).cast("array<struct<start:int,kind:int,end:int,match:string>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        span = F.struct(
            start.alias("start"), F.lit(order).alias("kind"), end.alias("end"),
            pair["match"].alias("match"),
        )
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    pairs = F.zip_with(
        F.slice(pieces, 1, F.size(matches)), matches,
        lambda p, m: F.struct(p.alias("piece"), m.alias("match")),
    )
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    walked = F.aggregate(pairs, start, step, lambda state: state["spans"])
    return F.when(text.rlike(pattern), walked).otherwise(empty)


def _entropy(candidate: Column) -> Column:
    """Greatest entropy, bits a character, of a window over an ASCII string.

    counts holds how often each code occurs in the window, sum the sum of c log2 c over them;
    the entropy is log2(WINDOW) - sum / WINDOW, so the least sum is kept.
    """
    weight = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)))

    def f(count: Column) -> Column:
        return F.element_at(weight, count + 1)

    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c))

    def step(state: Column, i: Column) -> Column:
        new = F.element_at(codes, i)
        old = F.when(i > WINDOW, F.element_at(codes, F.greatest(i - WINDOW, F.lit(1)))).otherwise(0)
        into = F.element_at(state["counts"], new + 1)
        out = F.element_at(state["counts"], old + 1)
        moved = F.when(new == old, 0.0).otherwise(
            f(into + 1) - f(into) + F.when(old > 0, f(out - 1) - f(out)).otherwise(0.0)
        )
        total = state["sum"] + moved
        counts = F.transform(
            state["counts"],
            lambda c, j: c + (j == new).cast("int") - ((j == old) & (old > 0)).cast("int"),
        )
        least = F.when(i >= WINDOW, F.least(state["least"], total)).otherwise(state["least"])
        return F.struct(counts.alias("counts"), total.alias("sum"), least.alias("least"))

    start = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(WINDOW * math.log2(WINDOW)).alias("least"),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.size(codes)), start, step,
        lambda s: F.lit(math.log2(WINDOW)) - s["least"] / WINDOW,
    )


def _random(span: Column) -> Column:
    """Whether a candidate, or a run of letters and digits in it, is random enough for its alphabet.

    Candidates of an allowed shape are not.
    """
    match = span["match"]

    def random(piece: Column) -> Column:
        least = F.lit(KEY_BITS)
        for pattern, bits in reversed(ALPHABETS):
            least = F.when(piece.rlike(pattern), bits).otherwise(least)
        shape = piece.rlike("[0-9]") & piece.rlike("[A-Za-z]")
        return F.when(shape, _entropy(piece) >= least).otherwise(F.lit(False))

    runs = F.regexp_extract_all(match, F.lit(RUN), F.lit(0))
    pieces = F.array_distinct(F.concat(F.array(match), runs))
    return F.when(match.rlike(ALLOWED), F.lit(False)).otherwise(F.exists(pieces, random))


def _once(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with blanks for the characters of sorted spans."""

    def step(state: Column, s: Column) -> Column:
        piece = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        blanks = F.repeat(F.lit(" "), s["end"] - F.greatest(state["at"], s["start"]))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.concat(state["out"], piece, blanks).alias("out"),
        )

    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )


def scan(text: Column) -> Column:
    """array<struct<start, kind, end>> of all secrets of a text, by start, then kind.

    kind is the place in KINDS. NULL gives an empty array. Base kinds as in the contract:
    leftmost matches that do not overlap within a kind, failing ones dropped after matching.
    Entropy spans are looked for in what base spans leave of the text.
    """
    text = F.coalesce(text, F.lit(""))
    assign = F.filter(
        _spans(text, ASSIGN, "assign"),
        lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_VALUE,
    )

    def narrow(spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")
            ),
        )

    def with_entropy(base: Column) -> Column:
        more = _once(
            F.when(F.size(base) > 0, _blanked(text, base)).otherwise(text),
            lambda left: narrow(F.filter(_spans(left, CANDIDATE, "entropy"), _random)),
        )
        return F.array_sort(F.concat(base, more))

    base = F.concat(assign, _spans(text, ACCESS, "access"), _spans(text, HEX, "hex"))
    return _once(F.array_sort(narrow(base)), with_entropy)


def secrets(docs: DataFrame) -> DataFrame:
    """Input rows as struct `row`, with `spans` as of scan()."""
    return row_and(docs, spans=scan(docs["text"]))


def redacted_text(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every secret replaced; spans that overlap give one mask."""

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        piece = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], piece, F.lit(mask))).alias("out"),
        )

    rest = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def redacted(docs: DataFrame) -> DataFrame:
    """All rows, secrets masked in text; n_chars, if there, is that of the new text."""
    found = secrets(docs).withColumn("new", redacted_text(F.col("row.text"), F.col("spans")))
    changed = F.size("spans") > 0
    columns = {
        "text": F.col("new"),
        "n_chars": F.when(changed, F.length("new").cast("long")).otherwise(F.col("row.n_chars"))
        if "n_chars" in docs.columns
        else None,
    }
    return found.select(
        *(
            columns[c].alias(c) if columns.get(c) is not None else F.col("row").getField(c).alias(c)
            for c in docs.columns
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op2: numbers and digest of the base spans, and all spans, of every document."""
    found = secrets(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, KINDS))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
            ),
            ",",
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("entropy"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *(number(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
