"""Language identification by Bayesian fusion of text, declared language, address suffix and host."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pixelloom.llm.common import materialise, small_side

#: Hash buckets of byte trigrams; languages whose counts a task holds at once.
BUCKETS, HELD_LANGUAGES = 1 << 15, 64
#: The class of text that is in none of the languages.
NONE = "und"
#: How much less likely than chance a trigram is under NONE, so that names and codes amid little text don't reject it.
NONE_PENALTY = 2.5
#: Weight of one trigram's log-likelihood: overlapping trigrams aren't independent evidence.
TEMPER = 0.2


def trigram_buckets(raw: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of UTF-8 text, A-Z lower-cased, digits and white space as one symbol each."""
    a = TABLE[np.frombuffer(raw, np.uint8)]
    return ((a[:-2] * 31 + a[1:-1]) * 131 + a[2:]) * 40503 >> 5 & (BUCKETS - 1) if len(a) > 2 else np.empty(0, np.int64)


def _table() -> np.ndarray:
    t = np.arange(256)
    t[65:91] += 32
    t[48:58] = 48
    t[[9, 10, 11, 12, 13]] = 32
    return t.astype(np.int64)


TABLE = _table()


@dataclass
class TextModel:
    """Log-probabilities of trigram buckets, a column for each language and one for NONE (uniform, less a penalty)."""

    languages: list[str]
    logp: np.ndarray

    def scores(self, text: bytes | None) -> np.ndarray:
        """Tempered log-likelihood of a text under each class."""
        total = np.zeros(len(self.languages) + 1)
        for at in range(0, len(text or b""), 1 << 18):
            total += self.logp[trigram_buckets(text[at : at + (1 << 18) + 2])].sum(axis=0, dtype=np.float64)
        return TEMPER * total


def learn(rows: DataFrame, per_language: int = 4_000) -> TextModel:
    """Model of (text, lang) rows: every language of the table, each from a sample of at most per_language of its rows.

    Languages and their counts are taken from all rows. A language of more rows is thinned by a hash of doc_id (of the text
    where there is none), so copies have no more weight than their number. Trigrams are counted for each language in the
    tasks and summed by a shuffle; languages x BUCKETS sums come back. Rows with a null or empty text or lang take no part.
    Without rows there are no languages.
    """
    code = F.xxhash64("doc_id", "text") if "doc_id" in rows.columns else F.xxhash64("text")
    rows = rows.select("text", "lang", code.alias("code")).where("lang IS NOT NULL AND length(text) > 0")
    found = rows.groupBy("lang").count()
    found = materialise(found, "languages")
    languages = [r.lang for r in found.orderBy(F.desc("count"), "lang").collect()]
    place = {lang: i for i, lang in enumerate(languages)}
    share = 1_000_000 * (1.1 * per_language + 50) / F.col("count")  # somewhat more than wanted; the rest goes by rank
    thin = rows.join(F.broadcast(found), "lang").where(F.pmod("code", F.lit(1_000_000)) < share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("code", F.lit(1_000_000)), "code"))
    rows = materialise(thin.withColumn("rank", rank).where(F.col("rank") <= per_language).select("text", "lang"), "lang-sample")

    def sums_of(seen: dict[int, np.ndarray]) -> pa.RecordBatch:
        at = [(k, np.flatnonzero(v)) for k, v in seen.items()]
        k, g, n = ([np.full(len(g), k) for k, g in at], [g for _, g in at], [seen[k][g] for k, g in at])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in ((k, pa.int32()), (g, pa.int32()), (n, pa.int64()))], names=["k", "g", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                if place[lang] not in seen and len(seen) == HELD_LANGUAGES:
                    yield sums_of(seen)
                    seen = {}
                found = np.bincount(trigram_buckets(text.as_py()), minlength=BUCKETS)
                seen[place[lang]] = seen[place[lang]] + found if place[lang] in seen else found
        if seen:
            yield sums_of(seen)

    raw = rows.select(F.col("text").cast("binary").alias("text"), "lang")
    sums = raw.mapInArrow(count, "k int, g int, n long").groupBy("k", "g").agg(F.sum("n").alias("n")).toArrow()
    seen = np.full((BUCKETS, len(languages)), 0.01)
    seen[sums.column("g").to_numpy(), sums.column("k").to_numpy()] += sums.column("n").to_numpy()
    logp = np.log(seen / seen.sum(axis=0, keepdims=True)) if languages else np.empty((BUCKETS, 0))
    return TextModel(languages, np.c_[logp, np.full(BUCKETS, -np.log(BUCKETS) - NONE_PENALTY)].astype(np.float32))


def _join_small(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a null-safe key; right has a row for each key and is broadcast while it is small."""
    side = small_side(right.withColumnRenamed(key, f"_{key}"))
    return left.join(side, F.col(key).eqNullSafe(F.col(f"_{key}")), "left").drop(f"_{key}")


def identify(
    docs: DataFrame, model: TextModel, declared: Column | None = None, host: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    min_posterior: float = 0.5, strength: float = 20.0,
) -> DataFrame:
    """(doc_id, lang, posterior, text_lang, declared, accepted) for every row.

    log posterior of a language = text log-likelihood + log P(declared | language) + log P(language | host).
    P(declared | language) and the host prior come from counts of the languages that texts alone suggest, grouped over
    all rows. The prior is smoothed from the whole to the address suffix (last label) to the host: each level adds
    ``strength`` rows' worth of the level above. Declared tags count by their part before - or _, lower-cased.

    A row is accepted if its class is a language with at least min_posterior and its text has letters. Null and empty
    texts have no letters: their class follows the other evidence and they aren't accepted. Null evidence adds nothing.
    Repeated rows repeat their result; very long texts are read whole; other columns are ignored, whatever their names.
    Only hosts x languages counts are joined back, on the host; they are broadcast while few.
    """
    names = [*model.languages, NONE]
    kind = docs.schema[id_col].dataType
    sent = docs.sparkSession.sparkContext.broadcast(model)
    tag = F.nullif(F.regexp_extract(F.lower(F.coalesce(declared, F.lit(""))), "^([a-z0-9]+)", 1), F.lit("")) if declared is not None else F.lit(None).cast("string")
    where = F.nullif(F.lower(host.cast("string")), F.lit("")) if host is not None else F.lit(None).cast("string")
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), tag.alias("declared"), where.alias("host"), letters.alias("letters"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([T.StructField("doc_id", kind)]).add("declared", "string").add("host", "string").add("letters", "boolean").add("ll", T.ArrayType(T.DoubleType()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [sent.value.scores(x.as_py()) for x in b.column(4)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(got, pa.list_(pa.float64()))], names=["doc_id", "declared", "host", "letters", "ll"])

    scored = rows.mapInArrow(score, schema)
    scored = scored.withColumn("k", F.when(F.col("letters"), F.array_position("ll", F.array_max("ll")).cast("int") - 1))
    scored = materialise(scored.withColumn("suffix", F.substring_index("host", ".", -1)), "language-scores")

    counts = [F.sum(F.when(F.col("k") == i, 1).otherwise(0)) for i in range(len(names))]

    def tally(key: str, above: Column, name: str) -> list[Column]:
        total = F.array(*counts)
        return [F.transform(total, lambda n, i: (n + strength * F.get(above, i)) / (F.aggregate(total, F.lit(0).cast("long"), lambda a, x: a + x) + strength)).alias(name)]

    seen = scored.where("k IS NOT NULL").agg(F.array(*counts).alias("n")).first().n
    every = [(n or 0) + 1 for n in seen]
    prior = F.array(*[F.lit(n / sum(every)) for n in every])
    by_suffix = scored.where("suffix IS NOT NULL").groupBy("suffix").agg(*tally("suffix", prior, "p_suffix"))
    by_host = scored.where("host IS NOT NULL").groupBy("host").agg(F.first("suffix").alias("suffix"), F.array(*counts).alias("n"))
    by_host = by_host.join(by_suffix, "suffix")
    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    by_host = materialise(by_host.select("host", F.transform("n", lambda n, i: (n + strength * F.get("p_suffix", i)) / (total + strength)).alias("p_host")), "hosts")
    tags = scored.where("declared IS NOT NULL").groupBy("declared").agg(F.array(*counts).alias("n"))
    known = max(1, tags.count())
    all_tags = scored.where("declared IS NOT NULL").agg(F.array(*counts).alias("n")).first().n
    of = F.array(*[F.lit(float((n or 0) + 1)) for n in all_tags])
    tags = materialise(tags.select("declared", F.transform("n", lambda n, i: (n + F.lit(1.0 / known)) / F.get(of, i)).alias("p_tag")), "tags")

    joined = _join_small(_join_small(scored, by_host, "host"), tags, "declared")
    log_prior = lambda i: F.log(F.coalesce(F.get("p_host", i), F.get(prior, i)))
    log_tag = lambda i: F.coalesce(F.log(F.get("p_tag", i)), F.lit(0.0))
    fused = joined.withColumn("z", F.transform("ll", lambda x, i: x + log_prior(i) + log_tag(i)))
    fused = fused.withColumn("top", F.array_max("z")).withColumn("at", F.array_position("z", F.col("top")).cast("int"))
    labels = F.array(*[F.lit(n) for n in names])
    posterior = 1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    fused = fused.select("doc_id", F.get(labels, F.col("at") - 1).alias("lang"), posterior.alias("posterior"), F.get(labels, F.col("k")).alias("text_lang"), "declared", "letters")
    accepted = F.col("letters") & (F.col("lang") != NONE) & (F.col("posterior") >= min_posterior)
    return fused.select("doc_id", "lang", "posterior", "text_lang", "declared", accepted.alias("accepted"))


def url_host(url: Column) -> Column:
    """Host of a URL without user and port; null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def markup_language(html: Column) -> Column:
    """The lang attribute of the html element; null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9_-]+)", 1), F.lit(""))


def markup_text(html: Column) -> Column:
    """The text of a page: scripts, styles, comments and tags become spaces."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
