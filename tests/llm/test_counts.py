"""Token counts, whitening and collocations against brute force."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pixelloom.llm import collocations, registry, token_counts, whitening
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
import public_tokenizers  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ODD = [
    "", " ", "plain words, and more words", "a<|endoftext|>b  <|endoftext|><|endoftext|>", "it's we'll\n\n\ttabs  end ", "naïve ÉCOLE 1234 ½ ²", "漢字とかな交じり 文", "🙂🙂 zero​width nbsp line",
    "x" * 30_000, "word " * 9_000, "\x00\x01\x7f", "ⅣⅫ ٣٤ ՙ ʰ ", "tie", "tie",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_equal_the_library(spark, name):
    path = public_tokenizers.path(name)
    tok = tokenizers.Tokenizer.from_file(path)
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, None, "x"), (3, ODD[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_tokens string")
    got = sorted(map(tuple, token_counts.token_counts(docs, path, limit=100).collect()), key=str)
    count = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)
    assert got == sorted(((i, len((t or "").encode()), count(t), count(t) > 100) for i, t, _ in rows), key=str)


def test_rare_pre_tokens_are_joined(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "COMMON", 5)
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tok = tokenizers.Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path).collect()}
    assert got == {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}


def test_token_counts_of_no_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = token_counts.token_counts(spark.createDataFrame([], "doc_id long, text string"), path)
    assert out.count() == 0 and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    with pytest.raises(ValueError):
        token_counts.token_counts(out.withColumn("text", F.lit("")), public_tokenizers.path("piece_bpe_32k.model"))


def test_token_counts_query(spark):
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False).ids) for r in docs}
    got = registry.op11_token_counts(spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and all(r.over_limit == (r.n_tokens > 1024) for r in got)


def brute_whiten(vectors, k):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    far = [sum((n * a - b) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    c = ((x * n - s) / n).astype(float)
    e, u = np.linalg.eigh(c.T @ c / n)
    return far, e[::-1][:k], e.sum(), c @ u[:, ::-1][:, :k] / np.sqrt(np.maximum(e[::-1][:k], 1e-300))


def test_whitening_equals_a_dense_solver(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    have = rows.orderBy("vec_id").collect()
    out = registry.op12_whitening(spark, SMALL).toPandas()
    far, e, trace, w = brute_whiten([r.embedding for r in have], 32)
    assert len(out) == len(have) * 32 and (out.identity_error <= 1e-9).all() and out.identity_error.nunique() == 1
    assert out.groupby("vec_id").deviation.first().tolist() == far
    assert np.allclose(out.groupby("component").explained.first(), e / trace, rtol=1e-10)
    got = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.abs((got * w).sum(axis=0)) / len(have) - 1).max() < 1e-9


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 0.5]), (2, [0.0, 1.0, 0.5]), (2, [0.0, 1.0, 0.5]), (None, [3.0, -1.0, 0.5])]
    bad = [(5, None), (6, [1.0, None, 2.0]), (7, [nan, 0.0, 0.0]), (8, [inf, 0.0, 0.0]), (9, []), (10, [1.0, 2.0])]
    frame = lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, n string")
    out = whitening.whiten(frame(good + bad)).toPandas()
    far, e, trace, w = brute_whiten([v for _, v in good], 2)
    assert sorted(out.component.unique()) == [1, 2] and (out.n == 4).all() and len(out) == 8  # the third dimension is constant
    assert sorted(out[out.component == 1].deviation) == sorted(far)
    assert np.allclose(sorted(out[out.component == 1].whitened.abs()), sorted(np.abs(w[:, 0])))
    assert np.allclose(sorted(out.explained.unique(), reverse=True), e / trace)
    for rows in ([], bad[:5], good[:1], good[1:3]):
        assert whitening.whiten(frame(rows)).count() == 0


def test_clustered_eigenvalues_and_more_components_than_the_block(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 40)) * np.r_[np.full(20, 9.0), np.full(20, 1.0)]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    op = whitening.Centred(whitening.whole_vectors(rows))
    e, u = whitening.leading_components(op, 6)
    c = np.floor(64 * x) + 1_000_000
    c -= c.mean(axis=0)
    v = c.T @ c / len(c)
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1][:6], rtol=1e-12)
    assert np.abs(v @ u - u * e).max() < 1e-11 * e[0] and np.abs(u.T @ u - np.eye(6)).max() < 1e-12


def brute_collocations(rows, least=10, words=3, top=2000, share=50):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + m]) for m in range(1, words + 1) for i in range(len(w) - m + 1))
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        gone = {g[i : i + m] for g, a in found.items() for m in range(2, len(g)) for i in range(len(g) - m + 1) if 100 * a >= share * counts[g[i : i + m]]}
        ranked = []
        for g in found.keys() - gone:
            a = found[g]
            score, k = min((1_000_000 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            ranked.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("words", "least", "top"), [(3, 10, 2000), (2, 5, 30), (5, 4, 2000)])
def test_collocations_equal_brute_force(spark, words, least, top):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = collocations.collocations(docs, min_count=least, words=words, top=top)
    assert sorted(map(tuple, got.collect())) == brute_collocations([(r.lang, r.text) for r in docs.collect()], least, words, top)


def test_collocations_of_odd_rows(spark, prose, monkeypatch):
    monkeypatch.setattr(collocations, "PATH_EDGES", 7)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 50)
    rows = [(None, "New York is big. new york"), ("en", None), ("en", ""), ("en", " \t "), ("und", "new york, new york!"), ("en", "a a a a a a a"), ("en", "a b c a b c a b c a"), ("en", "x\x0by z\x0cx y z " * 3), ("en", "é é é É"), ("de", prose(1, 60)), ("de", prose(1, 60)), ("de", prose(1, 6_000))]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string")
    got = collocations.collocations(docs, min_count=2)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 2)
    assert collocations.collocations(docs.where("lang = 'none'")).count() == 0


def test_unary_paths_are_compacted(spark):
    text = "p q r s t u v"
    docs = spark.createDataFrame([("en", text), ("en", text), ("en", "r s t z"), ("en", "r s t z")], "lang string, text string")
    e = collocations.edges(docs, 3).where("size = 3")
    found = {(tuple(r.w), tuple(r.c)) for r in collocations.paths(e, 3).collect()}
    assert found == {(("p", "q", "r", "s", "t"), (2, 2, 4)), (("s", "t", "u", "v"), (2, 2)), (("s", "t", "z"), (2,))}
