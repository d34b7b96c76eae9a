"""Classes of similar documents: every pair at the bound, against brute force."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pixelloom.llm import common, simhash


def shingles(text, k=5):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def classes(documents, texts):
    return {r.doc_id: r.component_id for r in simhash.similar_classes(documents([(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}


def test_pairs_just_above_and_below_the_bound(documents):
    random.seed(11)
    texts, near = [], []
    for i in range(300):  # the same words in both, so that the pair is sure to be compared
        words = [f"p{i}w{j}" for j in range(120)]
        base = words * 2 + random.choices(words, k=126 if i % 2 else 122)
        random.shuffle(base)
        other = list(base)
        for at in random.sample(range(1, len(base) // 6), 8):
            other[6 * at] = random.choice(words)
        if set(other) == set(base):
            texts += [" ".join(base), " ".join(other)]
            near.append(similarity(*texts[-2:]) >= 0.8)
    assert len(near) > 250 and 100 < sum(near) < len(near) - 100
    got = classes(documents, texts)
    wrong = [n for i, n in enumerate(near) if (got[2 * i] == got[2 * i + 1]) != n]
    assert not wrong, f"{wrong.count(True)} of {sum(near)} pairs lost, {wrong.count(False)} of {near.count(False)} linked wrongly"


def test_truncated_and_extended_copies(documents, prose):
    texts = []
    for i in range(120):
        more = (30, 50, 70, 85, 100)[i % 5]
        if i % 2:
            texts += [prose(f"b{i}", 404), f"{prose(f'b{i}', 404)} {prose(f'm{i}', more)}"]
        else:
            texts += [prose(f"b{i}", 404 + more), prose(f"b{i}", 404)]
    near = [similarity(*texts[i : i + 2]) >= 0.8 for i in range(0, len(texts), 2)]
    assert all(near)
    got = classes(documents, texts)
    lost = sum(got[2 * i] != got[2 * i + 1] for i in range(len(near)))
    assert lost == 0, f"{lost} of {len(near)} pairs lost"
    assert len(set(got.values())) == len(near)


def test_similar_sets_share_an_early_shingle():
    random.seed(2)
    number = lambda n: [random.getrandbits(64) for _ in range(n)]
    pool = number(400)
    order = simhash.Order({k: random.randint(5, 50) for k in pool})
    for bound in (0.5, 0.8, 0.95):
        for n in [*range(1, 60), 100, 333] * 4:
            both = random.sample(pool, min(n, 400) // 2) + number(n - min(n, 400) // 2)
            most = int(n / bound + 1e-9) - n  # as many elements as may differ
            mine = random.randint(0, most)
            a, b = (np.sort(np.array(both + number(m), dtype=np.uint64)) for m in (mine, most - mine))
            assert n / (n + most) >= bound
            for more in (0, 5, 64):
                first = [order.first(x, simhash.prefix_length(len(x), bound) + more) for x in (a, b)]
                assert len(np.intersect1d(*first)) > min(more, n - 1), (bound, n, more)
            apart = np.bitwise_count((simhash.sketch(a) ^ simhash.sketch(b)).view(np.uint64)).sum()
            assert apart <= most


def components(texts, bound=0.8):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [shingles(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= bound:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in range(len(texts))}


def test_families_that_share_a_template(documents, monkeypatch):
    """Copy families with a long passage in common, so that texts of many families share most shingles; all look further ahead."""
    monkeypatch.setattr(simhash, "CROWD", 1)
    random.seed(4)
    template = [f"t{i}" for i in range(304)]
    texts = []
    for f in range(60):  # two texts of a family are at 0.805, others at 0.777
        for c in range(2):
            texts.append(" ".join([*[f"f{f}w{i}" for i in range(6)], *template, *[f"f{f}c{c}n{i}" for i in range(37)]]))
    random.shuffle(texts)
    want = components(texts)
    assert len(set(want.values())) == 60
    got = classes(documents, texts)
    assert got == want, f"{len(set(got.values())) - 60} of 60 families torn"


def test_families_of_one_vocabulary(documents):
    random.seed(6)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(30):
        base = random.choices(vocabulary, k=240) + vocabulary
        random.shuffle(base)
        for c in range(4):
            at = random.randrange(len(base) - 20)
            texts.append(" ".join(base[: at] + random.sample(base[at : at + 5 * c], 5 * c) + base[at + 5 * c :]))
    random.shuffle(texts)
    assert classes(documents, texts) == components(texts)


def test_classes_of_the_table(spark, monkeypatch):
    """Every text with every other one, with and without texts that look further ahead."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = components([t for _, t in rows])
    ids = [i for i, _ in rows]
    want = {ids[i]: ids[c] for i, c in want.items()}
    assert {r.doc_id: r.component_id for r in simhash.similar_classes(docs).collect()} == want
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    monkeypatch.setattr(simhash, "CROWD", 0)
    assert {r.doc_id: r.component_id for r in simhash.similar_classes(docs).collect()} == want


def test_rows_that_stay(spark, prose):
    """Rows are judged by their text, not by their id; columns with names of the operator's own are kept."""
    a, b, c = prose("a", 80), prose("b", 80), prose("c", 80)
    rows = [(1, a, "x"), (2, a + " more", "x"), (2, b, "x"), (3, b, "x"), (None, c, "x"), (4, c + " end", "x"), (None, None, "x"), (None, "", "y"), (5, "", "x"), (6, "solo", "x"), (6, "solo", "y"), (None, "lone", "x"), (None, "lone", "y"), (7, prose("l", 30_000), "x"), (8, prose("l", 30_000) + " tail", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string").selectExpr("*", "node AS _node", "node AS _id", "node AS key")
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    want = [(1, a), (2, b), (4, c + " end"), (5, ""), (6, "solo"), (None, "lone"), (7, rows[13][1])]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0


def test_fingerprints_propose_pairs_that_whole_sets_decide(documents, prose, monkeypatch):
    """The classes come by SimHash links too: without any shared shingle to meet at, linked fingerprints still join copies, and only similar ones."""
    base = prose("f", 2000)
    rows = [(1, base, "en", "s"), (2, f"{base} end", "en", "s"), (3, prose("g", 60), "en", "s"), (4, base.upper(), "en", "s")]
    monkeypatch.setattr(simhash, "_leaders", lambda shared, similarity: shared.selectExpr("node AS a", "node AS b").limit(0))
    monkeypatch.setattr(simhash, "_across", lambda open_, similarity: open_.selectExpr("node AS a", "node AS b").limit(0))
    got = {r.doc_id: r.component_id for r in simhash.similar_classes(documents(rows)).collect()}
    assert got[3] == 3 and got[4] == 1 and got[2] == 1


def test_a_pair_with_many_keys_in_common_is_listed_once(spark, monkeypatch):
    """Two families with 30 keys in common, and texts with keys by chance: few rows, every pair of different classes that shares a key."""
    random.seed(8)
    rows = [(k, f * 100 + c, 40, k, f, 0) for f in (1, 2) for c in range(10) for k in range(30)]
    for node in range(1000, 1060):
        rows += [(100 + k, node, 40, i, node, 1000) for i, k in enumerate(sorted(random.sample(range(200), 25)))]
    open_ = spark.createDataFrame(rows, "key long, node long, n int, rank int, root long, big long").withColumn("pos", F.lit(0)).withColumn("m", F.lit(1))
    want = {(max(a, b), min(a, b)) for k, a, _, _, r, _ in rows for j, b, _, _, s, _ in rows if k == j and r != s}
    assert {tuple(r) for r in simhash._across(open_, 0.8).collect()} == want
    monkeypatch.setattr(simhash, "_ordered", lambda pairs, p, q: pairs.select(F.greatest(f"{p}.node", f"{q}.node"), F.least(f"{p}.node", f"{q}.node")))
    listed = [tuple(r) for r in simhash._across(open_, 0.8).collect()]
    assert set(listed) == want
    assert sum(a < 1000 for a, _ in listed) == 100 and len(listed) < 2.5 * len(want)


def test_texts_go_to_python_in_small_batches(documents, prose, spark, monkeypatch):
    name, seen, posts = "spark.sql.execution.arrow.maxBytesPerBatch", [], simhash.posts
    before = spark.conf.get(name)
    monkeypatch.setattr(simhash, "posts", lambda *a: (seen.append(spark.conf.get(name)), posts(*a))[1])
    docs = documents([(i, prose(i, 9000), "en", "s") for i in range(80)])
    simhash.similar_classes(docs)
    assert [int(x.removesuffix("b")) for x in seen] == [common.BATCH_BYTES] and spark.conf.get(name) == before

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    with common.small_batches(spark):
        got = docs.select("text").coalesce(1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 80 and max(r.size for r in got) < 1.2 * common.BATCH_BYTES


def test_long_texts_that_differ_are_ruled_out_unread(spark, prose):
    """Sketches grow with the text, and those of unlike lengths meet by folding; only the texts of pairs that may be similar are read again, once each."""
    base = prose("k", 4000)
    texts = {1: base, 2: f"{base} {prose('t', 300)}", 3: f"{prose('k', 2600)} {prose('u', 1400)}", 4: prose("v", 50)}
    docs = spark.createDataFrame([(i, t.encode()) for i, t in texts.items()] + [(1, base.encode())], "node long, raw binary")
    posted = common.materialise(simhash.posts(docs.distinct(), simhash.Order({}), 5, 0.8), "posted")
    assert len({len(r.sketch) for r in posted.collect()}) == 3
    asked = []

    def read(wanted):
        asked.extend(r.node for r in wanted.collect())
        return docs.join(wanted, "node", "left_semi")

    pairs = spark.createDataFrame([(2, 1), (3, 1), (3, 2), (4, 1)], "a long, b long")
    close = simhash.exact_pairs(read, posted.select("node", "n", "sketch"), pairs, 5, 0.8)
    assert [tuple(r) for r in close.collect()] == [(2, 1)] and sorted(asked) == [1, 2]


def test_folded_sketches_never_differ_in_more_bits_than_the_sets(spark):
    rng = np.random.default_rng(3)
    rows = []
    for both, mine, yours in [(400, 90, 30), (500, 0, 20), (1000, 30, 100), (2040, 10, 300), (2000, 900, 0), (100, 0, 4000), (3, 1, 1)]:
        h = np.unique(rng.integers(0, 1 << 63, both + mine + yours, dtype=np.uint64))
        rng.shuffle(h)
        a, b = np.sort(h[: both + mine]), np.sort(np.concatenate([h[:both], h[both + mine :]]))
        x, y = (simhash.sketch(v, simhash.sketch_bits(len(v))).tolist() for v in (a, b))
        rows += [(x, y, mine + yours), (y, x, mine + yours)]
    assert sum(len(x) != len(y) for x, y, _ in rows) == 6
    got = spark.createDataFrame(rows, "x array<long>, y array<long>, d int").select(simhash._apart("x", "y").alias("n"), "d").collect()
    assert all(r.n <= r.d and (r.d - r.n) % 2 == 0 and (r.n > 0) == (r.d > 0) for r in got)
