"""Mixing, nearest neighbours, token shards, archives and the pipeline."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pixelloom.llm import mixing, registry, token_shards
from pixelloom.llm.common import materialise, scratch_path
from pixelloom.llm.permutation_index import InvertedFiles, nearest_neighbours, ordered_pivots
from pixelloom.llm.warc import read_archives, write_archives

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("share", [{"a": 500, "b": 300, "c": 200}, {"a": 1, "b": 1, "c": 1}, {"a": 997, "b": 2, "c": 1}, {"x": 10}])
def test_period_is_pfair(share):
    d = sum(share.values())
    plan = mixing.period(share)
    assert [p[2] for p in plan] == list(range(d))
    done = collections.Counter()
    for s, k, slot in plan:
        assert k == done[s] and k * d // share[s] <= slot < -(-(k + 1) * d // share[s])
        done[s] += 1
        assert all(abs(done[x] - share[x] * (slot + 1) / d) < 1 for x in share)


def test_targets_and_shares():
    exact = lambda *a: mixing.shares(mixing.targets(*a))
    assert exact({"a": 1, "b": 1}, {"a": 3, "b": 1}) == {"a": 3, "b": 1}
    assert exact({"a": 1, "b": 1}, {"a": 1, "b": 2}) == {"a": 1, "b": 2}
    assert exact({"a": 1, "b": 1}, {"a": 0.9996, "b": 0.0004}) == {"a": 2499, "b": 1}
    assert exact({"a": 1, "b": 1, "c": 1}, {"a": 0.9998, "b": 0.0001, "c": 0.0001}) == {"a": 9998, "b": 1, "c": 1}
    assert exact({"a": 100, "b": 400}) == {"a": 1, "b": 2} and exact({}) == {}
    tight = mixing.shares(mixing.targets({"a": 1, "b": 1, "c": 1}, {"a": 10**6, "b": 1, "c": 1}), most=10)
    assert tight == {"a": 8, "b": 1, "c": 1}
    with pytest.raises(ValueError):
        mixing.targets({"a": 1}, {"a": 0})


@pytest.mark.parametrize("weights", [{"a": 1, "b": 2}, {"a": 0.9996, "b": 0.0004}, None])
def test_deviation_from_the_target(weights):
    """At every slot up to 100,000 each source has its unrounded weight to within one block."""
    counts = {"a": 10, "b": 10} if weights else {f"s{i}": 7 ** (i % 6) + 13 * i for i in range(8)}
    want = mixing.targets(counts, weights)
    share = mixing.shares(want)
    plan = [s for s, _, _ in mixing.period(share)]
    if weights is None:  # irrational: the targets are those of three digits
        most = max(counts.values()) ** 0.5
        total = sum(n**0.5 / most for n in counts.values())
        assert all(abs(float(want[s]) - n**0.5 / most / total) < 1e-3 for s, n in counts.items())
    number = {s: (w.numerator, w.denominator) for s, w in want.items()}
    done = dict.fromkeys(want, 0)
    for t in range(100_000):
        done[plan[t % len(plan)]] += 1
        if t % 97 == 0 or t < 3000:
            assert all(abs(done[s] * d - n * (t + 1)) < d for s, (n, d) in number.items())


def test_schedule(spark, documents):
    rows = [(i, f"t{i}", "en", "hot" if i % 3 else f"s{i % 4}") for i in range(3000)] + [(None, "n", None, None), (5, "t5", "en", "hot"), (5, "t5", "en", "hot")]
    df = documents(rows).withColumn("mix_slot", F.lit("mine"))
    got = mixing.schedule(df, block_rows=7).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.mix_slot < r.mix_due
    for mine in by.values():
        assert sorted((r.mix_block * 7 + r.mix_place) for r in mine) == list(range(len(mine)))
        order = sorted(mine, key=lambda r: (r.mix_slot, r.mix_place))
        key = [hashlib.md5(str(r.doc_id).encode()).hexdigest() for r in order if r.doc_id is not None]
        assert key == sorted(key)
    assert len({(r.mix_slot, r.mix_place) for r in got}) == len(got)
    nulls = [(None, f"n{i}", "en", "hot") for i in range(500)] + [(9, f"same {i}", "en", "hot") for i in range(500)]
    first, second = ({r.text: (r.mix_slot, r.mix_place) for r in mixing.schedule(documents(x), block_rows=7).collect()} for x in (nulls, nulls[::-1]))
    assert first == second and len(set(first.values())) == 1000  # no order of the input decides
    with pytest.raises(ValueError):
        mixing.schedule(df, max_sources=2)
    kept = mixing.mix(df, block_rows=7)
    assert kept.columns == df.columns and sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    path = scratch_path(spark, "mixed")
    mixing.mix(df, block_rows=7, file_slots=20).write.parquet(path)
    read = spark.read.parquet(path).select(mixing.file_order().alias("o"), "_metadata.row_index", "doc_id", "source").orderBy("o", "row_index").collect()
    assert [(r.doc_id, r.source) for r in read] == [(r.doc_id, r.source) for r in sorted(got, key=lambda r: (r.mix_slot, r.mix_place))]
    assert len({r.o for r in read}) > 3
    assert mixing.schedule(documents([])).count() == 0 and mixing.mix(documents([])).count() == 0
    plan = mixing.schedule(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_neighbours(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    e = df.toPandas()
    x, ids = np.stack(e.embedding.to_numpy()).astype(float), e.vec_id.to_numpy()
    got = nearest_neighbours(df, F.col("vec_id") % 20 == 0).toPandas()
    hit = 0
    queries = np.flatnonzero(ids % 20 == 0)
    for q in queries:
        s = x @ x[q]
        mine = got[got.query_id == ids[q]].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and ids[q] not in set(mine.vec_id)
        at = {v: s[i] for i, v in enumerate(ids)}
        assert np.allclose(mine.score, [at[v] for v in mine.vec_id]) and (np.diff(mine.score) <= 0).all()
        s[q] = -9
        hit += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(mine.vec_id))
    assert hit >= 0.9 * 20 * len(queries)


def test_inverted_files():
    random.seed(5)
    x, pivots = np.random.default_rng(5).normal(size=(60, 8)), np.random.default_rng(6).normal(size=(20, 8))
    files = InvertedFiles(np.arange(60), x, pivots, 7)
    lists = ordered_pivots(x, pivots, 7).tolist()
    place = lambda a, p: a.index(p) if p in a else 7
    for a in lists[:9]:
        want = [sum(abs(place(a, p) - place(b, p)) for p in {*a, *b}) for b in lists]
        assert files.footrule(np.array(a)).tolist() == want


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (40, [0.0, 0.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (3, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    three = df.unionByName(df.where("vec_id = 9").selectExpr("60L AS vec_id", "embedding", "rank"))  # each dimension by itself
    assert [(r.query_id, r.vec_id, r.score) for r in nearest_neighbours(three, F.col("vec_id") == 60).collect()] == [(60, 9, 14.0)]
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest_neighbours(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 2, 0.0), (20, 3, 3, 0.0)]
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 1000])
def test_feistel(n):
    f = token_shards.Feistel(n, 7)
    slots = f.slot(np.arange(n))
    assert sorted(slots) == list(range(n)) and (f.sequence(slots) == np.arange(n)).all()
    if n == 1000:
        assert (slots != token_shards.Feistel(n, 8).slot(np.arange(n))).any() and abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.15


def test_shards_round_trip(spark, documents):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [(i, t, "en", "s") for i, t in enumerate([*texts, None, "", "  two  spaces ", "x\n\n y\t<|endoftext|>", "é" * 5000, "word " * 100_000, "same", "same"])]
    df, path = documents(rows).repartition(3).checkpoint(), scratch_path(spark, "t")
    made = token_shards.write_shards(df, path, seq_len=128, shard_sequences=50).collect()
    meta = token_shards.read_manifest(path)
    ids = {r.slot: np.array(r.ids) for r in token_shards.read_slots(spark, path).collect()}
    assert sorted(ids) == list(range(meta["n_sequences"])) == sorted(r.slot for r in made)
    assert all(r.sha256 == hashlib.sha256(ids[r.slot].astype(np.uint16).tobytes()).hexdigest() for r in made)
    assert list(token_shards.Feistel(meta["n_sequences"], meta["key"]).slot([r.sequence for r in made])) == [r.slot for r in made]
    assert sorted(r.sequence for r in made) == sorted(ids) and all(r.shard == r.slot // 50 and r.offset == r.slot % 50 * 256 for r in made)
    assert [n for *_, n in meta["shards"]] == [50] * (len(ids) // 50) + [len(ids) % 50] * (len(ids) % 50 > 0)
    stream = np.concatenate([ids[r.slot][: r.n_tokens] for r in sorted(made, key=lambda r: r.sequence)])
    with open(token_shards.VOCABULARY, "rb") as f:
        coder = token_shards._encoding(f.read())
    found, start = [], 0
    for end in np.flatnonzero(stream == token_shards.END):
        found.append(coder.decode(stream[start:end].tolist()))
        start = end + 1
    assert sorted(found) == sorted(t or "" for _, t, *_ in rows)
    other = scratch_path(spark, "t")  # named streams, windows, and columns with names of the operator's own
    one = df.coalesce(1).sortWithinPartitions("doc_id").selectExpr("text", "'s' || (doc_id DIV 100) AS s", "doc_id AS slot", "doc_id AS stream", "doc_id AS ids")
    again = token_shards.write_shards(one, other, seq_len=128, shard_sequences=50, stream_col="s", window=40).collect()
    total = token_shards.read_manifest(other)["n_sequences"]
    assert sorted(r.slot for r in again) == list(range(total)) == sorted(r.sequence for r in again)
    assert all(r.slot // 40 == r.sequence // 40 for r in again) and sum(r.slot == r.sequence for r in again) < 0.2 * total
    read = {r.slot: np.array(r.ids) for r in token_shards.read_slots(spark, other).collect()}
    flat = np.concatenate([read[r.slot][: r.n_tokens] for r in sorted(again, key=lambda r: r.sequence)])
    assert sorted(coder.decode(flat[a + 1 : b].tolist()) for a, b in zip([-1, *np.flatnonzero(flat == token_shards.END)], np.flatnonzero(flat == token_shards.END), strict=False)) == sorted(found)
    part = {r.slot: np.array(r.ids) for r in token_shards.read_slots(spark, path, 37, 91).collect()}
    assert sorted(part) == list(range(37, 91)) and all((part[s] == ids[s]).all() for s in part)
    assert token_shards.write_shards(documents([]), scratch_path(spark, "t")).count() == 0


PAGES = [(1, "http://a/1", "x" * 200), (2, "http://a/2", "x" * 200), (3, None, "x" * 200), (4, "http://a/ 4\r\nX: y", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "é" * 50), (9, "u", "é" * 50), (10, "u", "WARC/1.1\r\n\r\nWARC-Type: response\r\n" * 9), (None, "u", "x" * 200), (None, "v", "z" * 200), (1, "http://a/1", "x" * 200), (11, "u", "q" * 300_000)]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archives(spark, compression):
    df = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    path = scratch_path(spark, "w")
    write_archives(df, path, compression)
    got = read_archives(spark, path).collect()
    assert len(got) == len(PAGES)
    first = {"x" * 200: 1, "é" * 50: 8}
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        again = html in first and i != first[html]
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[html] if again else None, None if again else raw))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.warc_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert all(r.payload is None for r in read_archives(spark, path, payload=False).collect())
    pushed = read_archives(spark, path).where("warc_type = 'revisit' AND page_id IN (2, 9)")
    assert {r.page_id for r in pushed.collect()} == {2, 9}


def test_archives_of_several_writes(spark):
    path, one = scratch_path(spark, "w"), lambda i: spark.createDataFrame([(i, f"u{i}", "x" * 200)], "page_id long, url string, html string")
    write_archives(one(1), path)
    write_archives(one(2), path)
    assert sorted(r.page_id for r in read_archives(spark, path).collect()) == [1, 2]
    write_archives(one(3), path, mode="overwrite")
    assert [r.page_id for r in read_archives(spark, path).collect()] == [3]
    ties = spark.createDataFrame([(1, u, "y" * 200) for u in "cab"] + [(2, "z", "y" * 200)], "page_id long, url string, html string")
    write_archives(ties, path, mode="overwrite")
    assert [(r.page_id, r.refers_to) for r in read_archives(spark, path).where("warc_type = 'revisit'").collect()] == [(2, 1)]


def test_foreign_archives(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    head = b"WARC/1.0\r\nWARC-Type: response\r\nX-Page-ID: none\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(body)
    (tmp_path / "a.warc").write_bytes((head + body + b"\r\n\r\n") * 2)
    got = read_archives(spark, f"file://{tmp_path}").collect()
    assert [(r.page_id, bytes(r.payload)) for r in got] == [(None, b"hello")] * 2
    (tmp_path / "a.warc").write_bytes(head + body[:-3])
    for payload in (True, False):
        with pytest.raises(Exception, match="ends before its length"):
            read_archives(spark, f"file://{tmp_path}", payload).collect()


def test_archives_of_no_pages(spark):
    path = scratch_path(spark, "w")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert read_archives(spark, path).count() == 0


def test_pipeline(spark):
    """Each stage against what it should keep, worked out on the driver."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "token_shards"]
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, SF)
    assert known.columns == docs.columns and known.count() >= 0.99 * docs.count()
    kept = stages["near_duplicates"](spark, docs, SF)
    sets = {}
    for r in docs.collect():
        w = r.text.lower().split()
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    for i in sets.keys() - ids:
        assert any(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.79 for j in sets if j < i)
    left = sorted(ids)
    for n, i in enumerate(left):
        assert not any(sets[i] == sets[j] for j in left[:n])
    clean = stages["decontamination"](spark, kept, SF)
    judged = registry.decontaminate(kept, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in judged.where("NOT contaminated").collect()}
    mixed = stages["mixing"](spark, clean, SF)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, clean.collect()))
    rows = stages["token_shards"](spark, materialise(mixed, "mixed"), SF).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    left = stages["decontamination"](spark, stages["near_duplicates"](spark, known, SF), SF)
    last = corpus_pipeline.run(spark, SF).collect()
    with open(token_shards.VOCABULARY, "rb") as f:
        vocabulary = f.read()
    tokens = sum(len(token_shards.encode(vocabulary, r.text)) // 2 + 1 for r in left.collect())
    assert sum(r.n_tokens for r in last) == tokens and sorted(r.slot for r in last) == list(range(len(last)))


def test_language_stage_judges_rows(spark):
    """Rows in no language go by themselves: without an id, beside a good row of their id, null, empty and repeated ones."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    first = docs.orderBy("doc_id").first()
    bad = [(first.doc_id, "123 456", "en", "s"), (None, "!!!", None, None), (None, "!!!", None, None), (-1, None, "en", "s"), (-2, "", None, "s")]
    both = docs.unionByName(spark.createDataFrame(bad, docs.schema)).unionByName(docs.where(docs["doc_id"] == first.doc_id).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source"))
    kept = sorted(((r.doc_id, r.text) for r in stage(spark, both, SF).collect()), key=str)
    want = [(r.doc_id, r.text) for r in stage(spark, docs, SF).collect()]
    assert (first.doc_id, first.text) in want and len(want) >= 0.99 * docs.count()
    assert kept == sorted([*want, (None, first.text)], key=str)


def test_stages_on_odd_rows(spark, documents, prose):
    """Nulls in all columns, empty and long texts, repeated rows, equal ids, and columns with names that operators use."""
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 200").first().text
    rows = [(1, None, None, None), (2, "", None, None), (None, "some words here and there", "en", None), (3, prose("a", 50), "en", "s"), (3, prose("a", 50), "en", "s"), (4, prose("long", 30_000), "en", "s"), (5, leak, "en", "s"), (None, f"x {leak}", "en", "s"), (6, prose("b", 40), None, None), (6, prose("c", 40), "xx", "s")]
    docs = documents(rows).selectExpr("*", "doc_id AS node", "text AS code", "source AS s", "lang AS mix_slot", "doc_id AS window", "doc_id AS stream")
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    every = [(r[0], r[1]) for r in rows]
    once = sorted({(i, t) for i, t in every if (i, t) != (2, "")}, key=str)
    once = [x for x in once if x[1] != f"x {leak}"]  # nearly the text of 5
    assert texts(stages["near_duplicates"](spark, docs, SF)) == once
    assert texts(stages["decontamination"](spark, docs, SF)) == sorted([x for x in every if leak not in (x[1] or "")], key=str)
    assert texts(stages["mixing"](spark, docs, SF)) == sorted(every, key=str)
    written = stages["token_shards"](spark, materialise(stages["mixing"](spark, docs, SF), "mixed"), SF).collect()
    with open(token_shards.VOCABULARY, "rb") as f:
        vocabulary = f.read()
    assert sum(r.n_tokens for r in written) == sum(len(token_shards.encode(vocabulary, t)) // 2 + 1 for _, t in every)
    empty = materialise(docs.limit(0), "none")
    assert stages["token_shards"](spark, empty, SF).count() == 0
