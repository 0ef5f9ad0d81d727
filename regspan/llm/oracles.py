"""SQL for DuckDB with the results of operators that SQL can express, by definition."""

from __future__ import annotations

from regspan.llm import ann, divergence, lexsearch, minhash, mixing, rules, secrets, suffixes

_WORD = "[^\\x20\\x09-\\x0D]+"


def _suffixes(length: int = suffixes.LENGTH) -> str:
    """Every window by its digest; those that are not the first of their kind are joined to spans."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, {2 * length})) AS k
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - {length - 1})) AS s FROM d)),
r AS (SELECT doc_id, s FROM w
      QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
g AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS span
      FROM (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {length}
                           THEN 0 ELSE 1 END AS fresh FROM r)),
spans AS (SELECT doc_id, min(s) AS a, max(s) + {length} AS b FROM g GROUP BY doc_id, span),
pieces AS (SELECT spans.doc_id, a, b, substr(h, 2 * before + 1, 2 * (a - before)) AS piece
           FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before
                 FROM spans) AS spans JOIN d USING (doc_id)),
joined AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS front, max(b) AS e,
             sum(b - a) AS gone, count(*) AS n FROM pieces GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(e, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN joined USING (doc_id)"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(pattern: str, kind: int, condition: str) -> str:
    """Matches of a pattern with their places: they end where pieces and matches before them do."""
    p = _quoted(pattern)
    return f"""SELECT doc_id, {kind} AS kind, m,
  CAST(list_sum(list_transform(pieces[1:i], lambda x: len(x))) AS BIGINT)
    + coalesce(CAST(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))) AS BIGINT), 0) AS a
FROM (SELECT *, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i
      FROM (SELECT doc_id, regexp_extract_all(t, {p}) AS ms, string_split_regex(t, {p}) AS pieces
            FROM t))
WHERE {condition}"""


def _secrets() -> str:
    """Base spans by pattern; candidates in the text with base spans blanked, each judged on
    itself and its runs of letters and digits by the limit of their alphabet."""
    width = secrets.WINDOW
    entropy = f"""list_max(list_transform(range(1, len(p) - {width - 2}), lambda i:
  list_entropy(string_split(p[i:i + {width - 1}], ''))))"""
    least = f"""CASE WHEN regexp_full_match(p, '[0-9A-Fa-f]+') THEN {secrets.HEX_BITS}
  WHEN regexp_full_match(p, '[A-Z2-7]+|[a-z2-7]+') THEN {secrets.BASE32_BITS}
  WHEN regexp_full_match(p, '[A-Z0-9]+|[a-z0-9]+') THEN {secrets.ONE_CASE_BITS}
  WHEN regexp_full_match(p, '[A-Za-z0-9]+') THEN {secrets.MIXED_BITS}
  WHEN regexp_matches(p, '[A-Z]') AND regexp_matches(p, '[a-z]') AND regexp_matches(p, '[0-9]')
    THEN {secrets.BASE64_BITS}
  ELSE {secrets.KEY_BITS} END"""
    random = f"""NOT regexp_matches(m, {_quoted(secrets.ALLOWED)}) AND list_bool_or(list_transform(
  list_distinct(list_concat([m], regexp_extract_all(m, {_quoted(secrets.RUN)}))), lambda p:
    regexp_matches(p, '[0-9]') AND regexp_matches(p, '[A-Za-z]') AND {entropy} >= {least}))"""
    names = ", ".join(f"'{k}'" for k in secrets.KINDS)
    joined = f"""coalesce(string_agg(list_value({names})[kind + 1] || ':' || a || ':' || b, ','
  ORDER BY a, kind)"""
    candidates = _matches(secrets.CANDIDATE, 3, random).replace("FROM t))", "FROM bl))")
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT *, a + len(m) AS b FROM (
{_matches(secrets.ASSIGN, 0, f"len(regexp_extract(m, {_quoted(secrets.ASSIGN)}, 2)) >= {secrets.ASSIGN_VALUE}")}
UNION ALL {_matches(secrets.ACCESS, 1, 'true')}
UNION ALL {_matches(secrets.HEX, 2, 'true')})),
covered AS (SELECT doc_id, list([a, b]) AS bs FROM base GROUP BY doc_id),
bl AS (SELECT t.doc_id, CASE WHEN bs IS NULL THEN t.t ELSE array_to_string(list_transform(
    range(1, len(t.t) + 1), lambda i: CASE WHEN list_bool_or(list_transform(bs, lambda s: s[1] < i AND i <= s[2]))
      THEN ' ' ELSE t.t[i] END), '') END AS t
  FROM t LEFT JOIN covered USING (doc_id)),
more AS (SELECT *, a + len(m) AS b FROM ({candidates})),
spans AS (SELECT doc_id, kind, a, b FROM base UNION ALL SELECT doc_id, kind, a, b FROM more)
SELECT t.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex,
  sha256({joined} FILTER (kind < 3), '')) AS base_sha256, {joined}, '') AS spans
FROM t LEFT JOIN spans USING (doc_id) GROUP BY t.doc_id"""


def _minhash() -> str:
    upper, n = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", minhash.SHINGLE
    percent = round(100 * minhash.THRESHOLD)
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{_WORD}') AS ws
  FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {n} THEN [ws]
        ELSE list_transform(range(1, len(ws) - {n - 2}), lambda i: ws[i:i + {n - 1}]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS (SELECT x.doc_id AS u, y.doc_id AS v
  FROM g x JOIN g y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  JOIN n a ON a.doc_id = x.doc_id JOIN n b ON b.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(node, other) AS (SELECT u, v FROM both_ways
  UNION SELECT node, v FROM reach JOIN both_ways ON other = u)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT w.doc_id, n.n, least(w.doc_id, coalesce(min(other), w.doc_id)) AS component_id
      FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON node = w.doc_id GROUP BY w.doc_id, n.n)"""


def _neighbours() -> str:
    finite = "list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"
    return f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE {finite} AND list_bool_or(list_transform(embedding, lambda x: x <> 0)))
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % {ann.QUERY_EVERY} = 0)
WHERE rank <= {ann.K}"""


def _distance(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of shares."""

    def half(x: str) -> str:
        return (
            f"list_sum(list_transform(range(1, len({p}) + 1), lambda i: CASE WHEN {x}[i] > 0 "
            f"THEN {x}[i] * log2({x}[i] / (({p}[i] + {q}[i]) / 2)) ELSE 0 END))"
        )

    return f"sqrt(greatest(0, ({half(p)} + {half(q)}) / 2))"


def _rules() -> str:
    judge = rules.Judge(rules.REFERENCES)
    common, references = judge._common, judge._references
    inside = {k: "".join(v).replace("\\", "\\\\") for k, v in rules.CLASSES.items()}
    chars = {
        "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": r"[\x20\x09-\x0D]",
        "stop": "[" + inside["stop"].replace("-", "\\-") + "]",
        "symbol": "[^a-zA-Z0-9\\x20\\x09-\\x0D" + inside["stop"].replace("-", "\\-") + "\\x80-\\x{10FFFF}]",
        "other": "[\\x80-\\x{10FFFF}]",
    }

    def number(pattern: str) -> str:
        return f"len(regexp_replace(t, {_quoted('[^' + pattern[1:] if pattern[1] != '^' else '[' + pattern[2:])}, '', 'g'))"

    def shares(values) -> str:
        total = float(sum(values))
        return "[" + ", ".join(f"{v / total!r}::DOUBLE" for v in values) + "]"

    classes = ", ".join(number(chars[c]) for c in rules.CLASS_NAMES)
    words = ", ".join(f"len(list_filter(lw, lambda x: x = '{w}'))" for w in common)
    passing = " OR ".join(
        f"((n_chars < {rules.MIN_CHARS} OR {_distance('cs', shares(c))} <= {rules.CLASS_LIMIT} + {rules.CLASS_SLACK} / sqrt(n_chars))"
        f" AND (n_words < {rules.MIN_WORDS} OR {_distance('wsh', shares(w))} <= {rules.WORD_LIMIT} + {rules.WORD_SLACK} / sqrt(n_words)))"
        for c, w in references
    )
    n = rules.WINDOW
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    symbols = rules.SYMBOLS.replace("$", "\\$").replace("|", "\\|").replace("*", "\\*")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws,
        regexp_extract_all(translate(t, '{upper}', '{upper.lower()}'), '{_WORD}') AS lw FROM d),
grams AS (SELECT doc_id, i, ws[i:i + {n - 1}] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM w)),
repeats AS (SELECT doc_id, count(DISTINCT j) AS n_repeat
  FROM (SELECT doc_id, unnest(range(i, i + {n})) AS j
        FROM (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1))
  GROUP BY doc_id),
lines AS (SELECT doc_id, sum(n - 1) AS n_dup FROM (
  SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id, line) GROUP BY doc_id),
c AS (SELECT w.doc_id, len(ws) AS n_words, len(t) AS n_chars,
    CAST(len(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_replace(t, '[^{symbols}]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
    [{classes}] AS cn, [{words}] AS wn
  FROM w LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)),
s AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    list_transform(cn, lambda x: x / greatest(n_chars, 1)) AS cs,
    list_transform(list_append(wn, n_words - CAST(list_sum(wn) AS BIGINT)), lambda x: x / greatest(n_words, 1)) AS wsh
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND ({passing}) AS kept
FROM s"""


def _mixing() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    n, most = len(mixing.WEIGHTS), mixing.MAX_REPEATS
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
    CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS hash
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [{weights}][CAST((row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) - 1) % {n} + 1 AS INT)] AS weight
  FROM d GROUP BY source),
-- Stopping sources in order of limit by weight, the level is highest with the right ones stopped.
levels AS (SELECT (sum(source_size) OVER () - {most} * coalesce(sum(source_size) OVER stopped, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER stopped, 0)) AS level
  FROM sources
  WINDOW stopped AS (ORDER BY {most} * source_size / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size,
    least({most}.0::DOUBLE * source_size, weight * (SELECT max(level)::DOUBLE FROM levels)) AS target FROM sources),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
places AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS want,
    sum(size) OVER (PARTITION BY d.source ORDER BY hash) AS upto,
    sum(size) OVER (PARTITION BY d.source, hash) AS words
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
edges AS (SELECT source, min(hash) AS edge FROM places WHERE upto > want GROUP BY source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE
    WHEN edge IS NULL THEN 0 WHEN hash < edge THEN 1
    WHEN hash = edge AND (want - upto + words) * 2 >= words THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM places LEFT JOIN edges ON places.source IS NOT DISTINCT FROM edges.source"""


def _terms(column: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (f"regexp_extract_all(translate(coalesce({column}, ''), '{upper}', '{upper.lower()}'), "
            f"{_quoted(lexsearch.TERM)})")


def _lexsearch(top: int = lexsearch.TOP) -> str:
    """Every document scored for every item by the contract's integer formula."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, {_terms('text')} AS t FROM documents),
st AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS big_n, sum(len(t)) AS big_l FROM d),
tf AS (SELECT rk, doc_id, n, term, count(*) AS tf
       FROM (SELECT rk, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({_terms('text')}) AS term FROM benchmark),
w AS (SELECT item_id, term,
        CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM q JOIN df USING (term), st),
sc AS (SELECT item_id, rk, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l)))) AS score
       FROM w JOIN tf USING (term), st GROUP BY item_id, rk, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM sc WHERE score > 0)
WHERE rank <= {top}"""


def _divergence() -> str:
    """Every group dense over its language's kept terms; pairs by a join on the term."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    t = (f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), "
         f"{_quoted(divergence.TERM)})")
    scale = divergence.SCALE
    return f"""
WITH r AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, {t} AS t FROM documents),
g AS (SELECT DISTINCT lang, source FROM r),
held AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(t)) AS term FROM r)
         GROUP BY lang, term HAVING count(*) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM held GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS cnt
      FROM (SELECT lang, source, unnest(t) AS term FROM r) JOIN held USING (lang, term) GROUP BY ALL),
gs AS (SELECT g.lang, g.source, coalesce(v.v, 0) + coalesce(s.n, 0) AS total
       FROM g LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(cnt) AS n FROM c GROUP BY ALL) s
       USING (lang, source)),
pp AS (SELECT gs.lang, gs.source, h.term,
         1 + (CAST(coalesce(c.cnt, 0) + 1 AS HUGEINT) * {scale}) // gs.total AS p
       FROM gs JOIN held h USING (lang) LEFT JOIN c USING (lang, source, term)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM pp a JOIN pp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM gs a JOIN gs b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
lc AS (SELECT lang, term, sum(cnt) AS cnt FROM c GROUP BY ALL),
lt AS (SELECT lang, v.v + (SELECT sum(cnt) FROM c WHERE c.lang = v.lang) AS total FROM v),
tp AS (SELECT c.lang, c.source, c.term AS item,
         1 + (CAST(c.cnt + 1 AS HUGEINT) * {scale}) // gs.total AS p,
         1 + (CAST(lc.cnt + 1 AS HUGEINT) * {scale}) // lt.total AS q
       FROM c JOIN gs USING (lang, source) JOIN lc USING (lang, term) JOIN lt USING (lang)),
terms AS (SELECT lang, source, 'term' AS part, item, ((p - q) * (p - q)) // q AS value FROM tp WHERE p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffixes": _suffixes(),
        "op2_secrets": _secrets(),
        "op3_minhash": _minhash(),
        "op4_neighbours": _neighbours(),
        "op6_rules": _rules(),
        "op8_mixing": _mixing(),
        "op11_lexsearch": _lexsearch(),
        "op12_divergence": _divergence(),
    }
