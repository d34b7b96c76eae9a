"""The languages of a model come from all rows."""

import collections
import math

import numpy as np
from pyspark.sql import functions as F

from pixelloom.llm import language_id, registry


def test_rare_languages_of_a_large_table(spark):
    many = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the cat and the house number "), "id").alias("text"), F.lit("en").alias("lang"))
    rare = spark.createDataFrame([(-1 - i, f"{chr(20_000 + i) * 3} {chr(20_000 + i) * 4} " * 5, f"r{i}") for i in range(80)], "doc_id long, text string, lang string")
    both = many.unionByName(rare)
    model = language_id.learn(both)
    assert sorted(model.languages) == sorted(["en", *[f"r{i}" for i in range(80)]])
    got = language_id.identify(rare, model).join(rare.select("doc_id", F.col("lang").alias("want")), "doc_id").collect()
    assert sum(r.lang == r.want and r.accepted for r in got) == 80


def test_copies_weigh_as_many_as_they_are(spark):
    own = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "zzz zzz").otherwise("aaa aaa").alias("text"), F.lit("en").alias("lang"))
    model = language_id.learn(own)
    share = [float(model.logp[language_id.trigram_buckets(t)[0], 0]) for t in (b"zzz", b"aaa")]
    assert 0.28 < 2.718281828 ** (share[0] - share[1]) < 0.39


def test_fusion_against_bayes_by_hand(spark):
    """Every posterior from its evidence, worked out on the driver."""
    strength = 20.0
    train = [("le chat et la maison de la rue " * 3, "fr"), ("der hund und das haus in der gasse " * 3, "de"), ("el perro y la casa de la calle " * 3, "es")] * 5
    model = language_id.learn(spark.createDataFrame(train, "text string, lang string"))
    said = ["le chat et la souris", "der hund und die katze", "el gato y la casa", "zz qq", "", None, "12 34"]
    hosts, tags = ["a.fr", "b.fr", "c.de", "d.de", "e.es", None, "localhost"], ["fr", "de-AT", "es_MX", None, "", "xx"]
    rows = [(i, said[(3 * i) % 7], hosts[(i * i) % 7], tags[i % 6]) for i in range(200)] + [(900, "le chat " * 60_000, "a.fr", "fr"), (5, said[0], "a.fr", None), (None, said[1], "c.de", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, host string, tag string").selectExpr("*", "doc_id AS k", "text AS ll", "tag AS declared", "host AS suffix", "text AS letters")
    got = language_id.identify(df, model, F.col("tag"), F.col("host")).collect()
    names = [*model.languages, language_id.NONE]
    known = []
    for i, text, host, tag in rows:
        ll = model.scores(text.encode() if text else None)
        tag = (tag or "").lower().replace("_", "-").split("-")[0] or None
        known.append((i, ll, int(np.argmax(ll)) if text and any(c.isalpha() for c in text) else None, host, tag))
    count = lambda test: np.array([sum(1 for x in known if x[2] == k and test(x)) for k in range(len(names))], float)
    prior = (count(lambda x: True) + 1) / (count(lambda x: True) + 1).sum()
    suffix = lambda h: h.split(".")[-1]
    smooth = lambda n, above: (n + strength * above) / (n.sum() + strength)
    p_suffix = {s: smooth(count(lambda x, s=s: x[3] and suffix(x[3]) == s), prior) for s in {suffix(h) for h in hosts if h}}
    p_host = {h: smooth(count(lambda x, h=h: x[3] == h), p_suffix[suffix(h)]) for h in hosts if h}
    n_tags = len({x[4] for x in known if x[4]})
    of = count(lambda x: x[4] is not None) + 1
    p_tag = {t: (count(lambda x, t=t: x[4] == t) + 1 / n_tags) / of for t in {x[4] for x in known if x[4]}}
    want = collections.Counter()
    for i, ll, k, host, tag in known:
        z = ll + np.log(p_host.get(host, prior)) + (np.log(p_tag[tag]) if tag else 0)
        best = int(np.argmax(z))
        top = 1 / np.exp(z - z[best]).sum()
        want[i, names[best], round(top, 6), k is not None and names[best] != language_id.NONE and top >= 0.5] += 1
    assert collections.Counter((r.doc_id, r.lang, round(r.posterior, 6), r.accepted) for r in got) == want
    assert all(math.isfinite(r.posterior) for r in got)


def test_documents_and_pages_in_one_call(spark):
    sf = "/root/testdata/sf0.001"
    got = registry.op9_language_id(spark, sf).collect()
    docs, pages = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/pages.parquet")
    assert sorted(r.doc_id for r in got if r.page_id is None) == sorted(r.doc_id for r in docs.collect())
    assert sorted(r.page_id for r in got if r.doc_id is None) == sorted(r.page_id for r in pages.collect())
    page = spark.createDataFrame([("<html><style>p {}</style><!-- no --><p class='a'>one<br>two</p><SCRIPT>x < 1</SCRIPT> three",), (None,)], "h string")
    assert [r[0].split() for r in page.select(language_id.markup_text(F.col("h"))).collect()] == [["one", "two", "three"], []]
