import random
from collections import defaultdict
from itertools import combinations

from regspan.llm import minhash
from regspan.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            holders[g].add(i)
    pairs = {p for h in holders.values() for p in combinations(sorted(h), 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def found(df):
    return {
        r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None
    }


def words(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def test_given_table(given):
    rows = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    assert found(minhash.near_duplicates(given)) == brute(rows)


def test_chains_thresholds_and_a_common_passage(docs_of):
    rows, n = [], 0
    passage = words(60, 0)
    for family in range(12):
        text = words(300, family + 1)
        for _ in range(12):  # each a little further from the first: links make a chain
            text = list(text)
            for place in random.Random(n).sample(range(300), 4):
                text[place] = f"new{n}"
            rows.append((n, " ".join(text)))
            n += 1
    for i in range(80):
        rows.append((n, " ".join(words(20 + i, 1000 + i) + passage)))
        n += 1
    rows += [(n + i, rows[i][1].upper()) for i in range(40)]
    rows += [(n + 100, "one two three"), (n + 101, "One  two\tTHREE"), (n + 102, "one two")]
    assert found(minhash.near_duplicates(docs_of(rows))) == brute(rows)


def test_odd_rows(odd, clashing, empty):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].component_id is None and by_id[None].kept
    assert by_id[10].component_id == 9 and not by_id[10].kept
    assert by_id[0].component_id == 0 and by_id[1].component_id == 1
    assert minhash.deduplicated(clashing).columns == clashing.columns
    assert minhash.deduplicated(clashing).count() == sum(r.kept for r in got)
    assert minhash.near_duplicates(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50 + i) for i in range(30)] + [(7, 7), (201, 200)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    expected = {i: 0 for i in range(1, 41)} | {i: 50 for i in [*range(51, 80), 100]} | {201: 200}
    assert roots == expected
