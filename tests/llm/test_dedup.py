"""Suffix array and SimHash against brute force."""

import random
from itertools import combinations

import xxhash

from pixelloom.llm import simhash
from pixelloom.llm.common import components
from pixelloom.llm.suffix_array import repeated_passages

SF = "/root/testdata/sf0.001"


def brute_repeats(rows, n):
    words = {i: (t or "").encode().lower().split() for i, t in rows if i is not None}
    seen = {}
    for i, w in words.items():
        for j in range(len(w) - n + 1):
            seen.setdefault(tuple(w[j : j + n]), set()).add(i)
    out = {}
    for i, w in words.items():
        spans = []
        for j in range(len(w) - n + 1):
            if len(seen[tuple(w[j : j + n])]) > 1:
                if spans and spans[-1][1] >= j:
                    spans[-1] = (spans[-1][0], j + n)
                else:
                    spans.append((j, j + n))
        if spans:
            out[i] = spans
    return out


def got_repeats(df, n, window):
    return {r.doc_id: [tuple(s) for s in r.spans] for r in repeated_passages(df, n, window).collect()}


def test_passages_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert got_repeats(df, 50, 25) == brute_repeats([(r.doc_id, r.text) for r in df.collect()], 50)


def test_passages_from_few_words(documents):
    random.seed(3)
    rows = []
    for i in range(60):
        rows.append((i, " ".join(random.choice("ab") if random.random() < 0.3 else random.choice("cdefgh") for _ in range(80)), "en", "s"))
    shared = rows[0][1].split()
    for i in range(20, 40):  # the same words with many different surroundings
        w = rows[i][1].split()
        a, b = random.randint(0, 40), random.randint(14, 40)
        rows[i] = (i, " ".join(w[: random.randint(0, 30)] + shared[a : a + b] + w[40:]), "en", "s")
    rows += [(100, "x " * 200, "en", "s"), (101, "x " * 90, "en", "s"), (102, rows[5][1], "en", "s")]
    df = documents(rows)
    assert got_repeats(df, 20, 8) == brute_repeats([(r[0], r[1]) for r in rows], 20)


def test_passages_of_odd_rows(documents, prose):
    a = prose("a", 60)
    rows = [(1, a, "en", "s"), (1, a, "en", "s"), (None, a, "en", "s"), (2, None, None, None), (3, "", "en", "s"), (4, prose("b", 30000), "en", "s")]
    assert got_repeats(documents(rows), 50, 25) == {}
    assert got_repeats(documents([*rows, (5, a + " tail", None, None)]), 50, 25) == {1: [(0, 60)], 5: [(0, 60)]}
    assert got_repeats(documents([]), 50, 25) == {}


def test_words_with_equal_prints(documents, prose):
    """Two words whose hashes begin alike are still two words."""
    a, b = "q253", "q544"
    assert xxhash.xxh64_intdigest(a.encode()) >> 48 == xxhash.xxh64_intdigest(b.encode()) >> 48
    rows = []
    for i in range(30):
        w = prose(f"p{i}", 50).split()
        at = (7 * i) % 50
        rows += [(2 * i + k, " ".join([*w[:at], x, *w[at + 1 :]]), "en", "s") for k, x in enumerate((a, b))]
    assert got_repeats(documents(rows), 50, 25) == {}
    longer = [(100, f"{prose('p', 30)} {a} {prose('q', 40)}", "en", "s"), (101, f"{prose('p', 30)} {b} {prose('q', 40)}", "en", "s"), (102, f"x {prose('p', 30)} {a} {prose('q', 25)}", "en", "s")]
    assert got_repeats(documents(rows + longer), 50, 25) == {100: [(0, 56)], 102: [(1, 57)]}


def brute_fingerprint(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(fps, distance):
    root = {i: i for i, _ in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in combinations(fps, 2):
        if (a ^ b).bit_count() <= distance and find(i) != find(j):
            low, high = sorted((find(i), find(j)))
            root[high] = low
    return {i: find(i) for i, _ in fps}


def test_simhash_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    fps = [(r.doc_id, brute_fingerprint(r.text, 3)) for r in df.collect()]
    want = brute_classes(fps, 2)
    got = simhash.near_duplicate_classes(df, 3, 2).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{f:016x}", want[i]) for i, f in fps}


def test_links_of_near_fingerprints(spark):
    random.seed(1)
    values = set()
    for _ in range(30):
        v = random.getrandbits(64)
        values.add(v)
        for _ in range(random.randint(0, 5)):
            v ^= sum(1 << b for b in random.sample(range(64), random.randint(1, 3)))
            values.add(v)
    rank = {v: i for i, v in enumerate(sorted(values))}
    want = brute_classes([(rank[v], v) for v in values], 2)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    nodes = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    back = {s: v for v, s in signed.items()}
    found = {}
    for r in components(simhash.links(nodes, 2)).collect():
        found.setdefault(r.root, set()).add(rank[back[r.node]])
    groups = {}
    for i, c in want.items():
        groups.setdefault(c, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (100, 150)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {200: 100, 150: 100, 100: 100}
    assert components(edges.limit(0)).count() == 0


def test_simhash_of_odd_rows(documents, prose):
    rows = [(5, None, None, None), (3, "", "en", "s"), (7, " \n\t", "en", "s"), (1, "one", "en", "s"), (2, "ONE", "en", "s"), (None, "one", "en", "s"), (9, prose("z", 40000), "en", "s"), (9, "other", "en", "s")]
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicate_classes(documents(rows)).collect())
    want = sorted((str(i), f"{brute_fingerprint(t, 3):016x}", {5: 3, 3: 3, 7: 3, 1: 1, 2: 1, None: 1, 9: 9}[i]) for i, t, *_ in rows)
    assert got == want
    assert simhash.near_duplicate_classes(documents([])).count() == 0


def shingle_set(text, k=5):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def test_similar_classes(documents, prose):
    random.seed(5)
    rows, group = [], {}
    for g in range(12):
        base = prose(g, random.choice((40, 200, 900))).split()
        for c in range(4):
            w = list(base)
            for _ in range(c * len(w) // 150):
                w[random.randrange(len(w))] = f"new{random.random()}"
            rows.append((len(rows), " ".join(w), "en", "s"))
            group[len(rows) - 1] = g
    got = {r.doc_id: r.component_id for r in simhash.similar_classes(documents(rows)).collect()}
    sets = {i: shingle_set(t) for i, t, *_ in rows}
    linked = []
    for (i, a), (j, b) in combinations(sets.items(), 2):
        if group[i] != group[j]:
            assert got[i] != got[j]
        elif len(a & b) / len(a | b) >= 0.8:
            linked.append(got[i] == got[j])
    assert len(linked) > 30 and all(linked)
    odd = [(1, None, None, None), (2, "", None, None), (None, "a b c d e f", None, None), (4, "a b c d e f", None, None), (4, "a b c d e f", None, None)]
    found = sorted((str(r.doc_id), r.component_id) for r in simhash.similar_classes(documents(odd)).collect())
    assert found == [("1", 1), ("2", 1), ("4", 4), ("4", 4), ("None", 4)]
    assert simhash.similar_classes(documents([])).count() == 0
