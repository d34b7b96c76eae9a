"""Toxicity, decontamination, URL rules and language ID."""

import hashlib
import itertools
import math
import random
import re

from pyspark.sql import functions as F

from pixelloom.llm import language_id, registry, toxicity
from pixelloom.llm.decontaminate import decontaminate
from pixelloom.llm.url_filter import UrlTrie, judge_urls

SF = "/root/testdata/sf0.01"


def brute_hits(text, items, n=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = split(text), set(), set()
    for item, t in items:
        u = split(t)
        for i in range(max(1, len(u) - n + 1)) if u else ():
            win = u[i : i + n]
            for j in range(len(w) - len(win) + 1):
                if w[j : j + len(win)] == win:
                    hit |= set(range(j, j + len(win)))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination_of_odd_rows(spark, documents, prose):
    long = prose("item", 25)
    items = [(1, long), (10, "Only Two"), (2, "single"), (3, ""), (4, None), (5, "ÉCOLE a b c d e f g h i j")]
    texts = [None, "", long, f"x {long.upper()} y", "so only two; and SINGLE, only  two only", prose("other", 500), "École a b c d e f g h i j", "ÉCOLE a b c d e f g h i", " ".join(long.split()[:9]), "only-two " * 3000]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, long, None, None), (2, long, None, None), (2, "single", None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(str, [tuple(r) for r in decontaminate(documents(rows), bench).collect()]))
    assert got == sorted(map(str, [(i, *brute_hits(t, items)) for i, t, *_ in rows]))
    assert decontaminate(documents(rows), bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate(documents([]), bench).count() == 0


def test_decontamination_is_native(spark):
    plan = registry.op5_decontaminate(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_urls(spark):
    urls = ["http://A.com", "http://a.com/", "http://example.com/en/x", "https://www.example.com/en/x?q", "http://x.www.example.com/en/", "http://example.com/enx", "ftp://b.net/fr/1#z", "http://net/es/", "http://xnet/es/", "nothing", None, "", "http://q.com:80/", "http://c.net/fr", "http://a.com/é/ü?"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[2], "h"), (3, urls[3], "h")], "page_id long, url string, host string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, registry.RULES).collect()}

    def want(i, u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h), len(p), f"{h}{p}", v) for v, h, p in registry.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (i, host, path, *(max(fits)[2:] if fits else (None, "allow")))

    assert got == {want(i, u) for i, u in enumerate(urls)} | {want(None, urls[2]), want(3, urls[3])}
    assert judge_urls(df.limit(0), registry.RULES).count() == 0


def test_trie_prefers_longer_rules():
    trie = UrlTrie([("block", "", "/"), ("allow", "a.b", ""), ("block", "b", "/x/y"), ("allow", "b", "/x/")])
    assert trie.match("b", "/x/yes")[1] == "block" and trie.match("b", "/x/no")[1] == "allow"
    assert trie.match("z.a.b", "")[1] == "allow" and trie.match("q", "/1")[1] == "block" and trie.match("q", "") is None


def paths(machine, symbols):
    """Every accepting path's outputs, by enumeration."""
    found = [(machine.start, ())]
    for s in symbols:
        found = [(after, (*out, o)) for q, out in found for after, o in machine.arcs.get((q, s), ())]
    return sorted(out for q, out in found if q in machine.finals)


def test_composition_of_small_machines():
    random.seed(4)
    for _ in range(60):
        a, b = (toxicity.reachable(0, "ab", lambda q, s, t={(q, s): [(random.randrange(3), random.choice("ab")) for _ in range(random.randrange(3))] for q in range(3) for s in "ab"}: t[q, s], lambda q: q != 1) for _ in range(2))
        both = toxicity.compose(a, b)
        for n in range(5):
            for w in itertools.product("ab", repeat=n):
                assert paths(both, w) == sorted(out for mid in paths(a, w) for out in paths(b, mid))


def brute_labels(symbols):
    """What each hit should be labelled, straight from the rules."""
    out = []
    target, report = "Y" in symbols, "R" in symbols
    for i, s in enumerate(symbols):
        if s == "T" and not target:
            s = "x"
        elif s in "IT":
            s += "+" if target else ""
            near = [j for j, n in enumerate(symbols) if n == "N" and (0 < i - j <= toxicity.REACH or 0 < j - i <= toxicity.REACH_BACK) and not set("CO") & set(symbols[min(i, j) : max(i, j)])]
            s += "~" if report else "-" if near else ""
        out.append(s)
    return out


def test_grammar_has_one_path_for_every_sentence():
    random.seed(8)
    machine = toxicity.grammar_machine()
    for n in [*range(5)] * 40 + [12, 25] * 60:
        symbols = random.choices(toxicity.SYMBOLS, [2, 1, 1, 2, 0.3, 1, 0.5, 8], k=n)
        assert machine.outputs(symbols) == brute_labels(symbols), symbols
        if n < 13:
            assert len(paths(machine, symbols)) == 1


def test_toxicity_grammar():
    g = toxicity.Grammar({"idiot": 6.0, "schwach*": 5.0})
    at = toxicity.PLACES
    assert g.weight("idiot") == 6 and g.weight("schwachkopf") == 5 and g.weight("schwach") == 0 and g.weight("idiotic") == 0
    said = {t: g.features(t) for t in ("you idiot.", "you are not an idiot.", "they said: you idiot.", "an idiot", "You fool, not an idiot", "not today, you idiot", "idiot you aren't", "I will kill the lights.", "I will kill you.", "I won't, never kill you")}
    label = {t: [k for k in at if f[at[k]]] for t, f in said.items()}
    assert list(label.values()) == [["I+"], ["I+-"], ["I+~"], ["I"], ["I+-"], ["I+"], ["I+-"], [], ["T+"], ["T+-"]]
    assert said["you idiot."][at["I+"]] == 6 and said["you idiot."][-1] == math.log(2)
    assert g.score("you idiot") > g.score("you are not an idiot") > g.score("a fine day") == g.score(None) == g.score("")


def test_toxicity_held_out(spark):
    got = registry.op2_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r.score for r in got if r.toxic == 0]
    bad = [r.score for r in got if r.toxic == 1]
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.8 and sum(s >= 0.7 for s in good) <= 0.03 * len(good)


def test_toxicity_of_odd_rows(spark, documents):
    g = toxicity.Grammar({"idiot": 6.0})
    rows = [(1, None, None, None), (2, "", None, None), (None, "idiot", None, None), (4, "idiot " * 30000, None, None), (4, "idiot", None, None)]
    got = toxicity.score_texts(documents(rows), g).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert toxicity.score_texts(documents([]), g).count() == 0
    assert toxicity.learn(spark.createDataFrame([("a", 0)], "text string, label int")).lexicon == {}


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.learn(docs.where("doc_id % 2 = 0"))
    got = language_id.identify(docs.where("doc_id % 2 = 1"), model).join(docs, "doc_id").select(F.col("text_lang"), docs["lang"], "accepted").collect()
    assert sum(r[0] == r[1] for r in got) > 0.97 * len(got) and sum(r.accepted for r in got) > 0.98 * len(got)


def test_language_evidence(spark):
    rows = [(1, "fr", "http://a.fr/1"), (2, None, "http://a.fr/2"), (3, "de", "http://b.de/"), (4, "de-AT", None), (None, None, None), (6, "xx", "nothing")]
    texts = {1: "le chat et la souris", 2: "", 3: "der hund und die katze", 4: "12 34", None: "zzzz", 6: None}
    train = [("le chat et la maison de la rue " * 3, "fr"), ("der hund und das haus in der gasse " * 3, "de")] * 5
    model = language_id.learn(spark.createDataFrame(train, "text string, lang string"))
    seed = [(100 + i, "fr" if i % 2 else "de", f"http://{'a.fr' if i % 2 else 'b.de'}/{i}", ("le chat et la maison" if i % 2 else "der hund und das haus")) for i in range(60)]
    df = spark.createDataFrame([(i, d, u, texts[i]) for i, d, u in rows] + seed, "doc_id long, tag string, url string, text string")
    got = {r.doc_id: r for r in language_id.identify(df, model, F.col("tag"), language_id.url_host(F.col("url"))).collect()}
    assert len(got) == 66 and got[1].lang == "fr" and got[1].accepted and got[3].lang == "de"
    assert got[2].lang == "fr" and not got[2].accepted and got[4].lang == "de" and not got[4].accepted and got[6].text_lang is None
    assert all(0 < r.posterior <= 1 + 1e-9 and math.isfinite(r.posterior) for r in got.values())
    assert language_id.identify(df.limit(0), model).count() == 0
    empty = language_id.learn(df.limit(0).select("text", F.col("tag").alias("lang")))
    assert {r.accepted for r in language_id.identify(df, empty).collect()} == {False}


def test_markup_and_host(spark):
    row = spark.createDataFrame([('<!DOCTYPE html><html class="a" lang="pt-BR"><body>', "https://u@www.x.example.com:8080/a?b"), (None, None), ("<p lang=en>", "x")], "h string, u string")
    got = [tuple(r) for r in row.select(language_id.markup_language(F.col("h")), language_id.url_host(F.col("u"))).collect()]
    assert got == [("pt-BR", "www.x.example.com"), (None, None), (None, None)]
