"""Passages that repeat across documents, found with a sparse suffix array over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from pixelloom.llm.common import materialise, small_side

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Words of the grams by whose hash minimisers are chosen.
GRAM = 8


def word_hashes(raw: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text: A-Z lower-cased, split at ASCII white space."""
    return np.array([xxh64_intdigest(w) for w in raw.lower().split()] if raw else [], dtype=np.uint64)


def _powers(b: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, b, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def span_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive word hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(BASE, len(h)), dtype=np.uint64)])
    x = (total[n:] - total[:-n]) * _powers(INVERSE, len(h) - n + 1)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def minimisers(h: np.ndarray, core: int, window: int) -> np.ndarray:
    """Starts of the retained suffixes: in each run of window starts with core words left, that of the least gram hash."""
    n = len(h) - core + 1
    if n < window:
        return np.empty(0, np.int64)
    v = span_hashes(h, GRAM)[:n]
    runs = np.lib.stride_tricks.sliding_window_view(v, window)
    return np.unique(np.arange(len(runs)) + runs.argmin(axis=1))


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns of a and b agree, row by row."""
    return np.logical_and.accumulate(a == b, axis=1).sum(axis=1)


def _neighbours(order: list[str], reach: int, name: str):
    """mapInArrow function over sorted suffixes: adds ``name``, the words that each shares with its neighbours.

    At both ends of a partition the outer neighbour isn't known, so all ``reach`` words are assumed; the exact test that
    follows makes up for it.
    """
    context = order[1]

    def table(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        sig = b.column(b.schema.get_field_index("sig")).to_numpy()
        raw = b.column(b.schema.get_field_index(context)).to_pylist()
        words = np.zeros((len(raw), reach), np.int64)
        for i, x in enumerate(raw):
            w = np.frombuffer(x, np.uint16)
            words[i, : len(w)] = w
            words[i, len(w) :] = -1 - (i & 1)  # a missing word agrees with none
        return sig, words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last batch, whose last row waits for its next neighbour

        def ready(b, got) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.int32())], names=[*b.schema.names, name])

        for b in batches:
            if not b.num_rows:
                continue
            sig, words = table(b)
            got = np.zeros(b.num_rows, np.int64)
            both = np.where(sig[1:] == sig[:-1], _shared(np.where(words[1:] < 0, -9, words[1:]), words[:-1]), 0)
            got[1:], got[:-1] = both, np.maximum(got[:-1], both)
            got[1:] = np.maximum(got[1:], both)
            if held is None:
                got[0] = reach
            else:
                old, old_got, old_sig, old_words = held
                near = int(_shared(np.where(words[:1] < 0, -9, words[:1]), old_words)[0]) if old_sig == sig[0] else 0
                got[0], old_got[-1] = max(got[0], near), max(old_got[-1], near)
                yield ready(old, old_got)
            held = (b, got, sig[-1], words[-1:])
        if held is not None:
            held[1][-1] = reach
            yield ready(held[0], held[1])

    return run


def suffixes(docs: DataFrame, core: int, window: int) -> DataFrame:
    """(sig, doc_id, pos) of every retained suffix; sig is a hash of its first core words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig, ids, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for doc, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                h = word_hashes(raw.as_py())
                pos = minimisers(h, core, window)
                sig.append(span_hashes(h, core)[pos] if len(pos) else sig[0])
                ids.append(np.full(len(pos), doc))
                at.append(pos)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(at).astype(np.int32))], names=["sig", "doc_id", "pos"])

    return docs.mapInArrow(run, "sig long, doc_id long, pos int")


def surroundings(h: np.ndarray, pos: int, core: int, reach: int) -> int:
    """A hash of the words up to reach on either side of a core, and of where the core stands among them."""
    low = max(0, pos - reach)
    return xxh64_intdigest(h[low : pos + core + reach].tobytes(), pos - low) - (1 << 63)


def _of_kept(docs: DataFrame, core: int, reach: int, rows_of, schema: str) -> DataFrame:
    """mapInArrow over (doc_id, raw, kept array of structs with pos and sig): rows_of(doc, word hashes, struct) for each suffix that the text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.split() for f in schema.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        for b in batches:
            out: list[tuple] = []
            for doc, raw, kept in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                h = word_hashes(raw.as_py())
                sigs = span_hashes(h, core).view(np.int64)
                fit = [x for x in kept if x["pos"] < len(sigs) and sigs[x["pos"]] == x["sig"]]
                out.extend(rows_of(doc, h, fit))
            columns = list(zip(*out, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    return docs.mapInArrow(run, schema)


def contexts(docs: DataFrame, core: int, reach: int) -> DataFrame:
    """(sig, doc_id, pos, left, right, context): 16-bit prints of the reach words on either side of the core, nearest first, and a hash of the words."""

    def rows_of(doc: int, h: np.ndarray, kept: list) -> Iterator[tuple]:
        prints = (h >> np.uint64(48)).astype(np.uint16)
        for x in kept:
            p = x["pos"]
            left, right = prints[max(0, p - reach) : p][::-1], prints[p + core : p + core + reach]
            yield x["sig"], doc, p, left.tobytes(), right.tobytes(), surroundings(h, p, core, reach)

    return _of_kept(docs, core, reach, rows_of, "sig long, doc_id long, pos int, left binary, right binary, context long")


def passages(docs: DataFrame, core: int, reach: int) -> DataFrame:
    """(sig, context, a, b, l, passage): for each l from least to most a hash of the words that begin l words before the core."""

    def rows_of(doc: int, h: np.ndarray, kept: list) -> Iterator[tuple]:
        whole = span_hashes(h, core + reach).view(np.int64)
        for x in kept:
            if surroundings(h, x["pos"], core, reach) == x["context"]:
                for before in range(x["least"], x["most"] + 1):
                    yield x["sig"], x["context"], x["a"], x["b"], before, int(whole[x["pos"] - before])

    return _of_kept(docs, core, reach, rows_of, "sig long, context long, a long, b long, l int, passage long")


def repeated_passages(docs: DataFrame, min_words: int = 50, window: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_repeated, spans) of documents with passages of min_words or more that another doc_id has too.

    spans: sorted, disjoint (start, stop) in words; a word is in one if and only if it is in some min_words consecutive
    words that also stand in a document with another id. Words are compared with A-Z lower-cased.

    1. A suffix is retained where it is a minimiser. Any min_words words hold a retained suffix with its first
       min_words - window + 1 words, its core; suffixes whose core no other document has are dropped.
    2. The others are sorted by core and following words (and again by core and preceding words) over range partitions;
       neighbours, by short prints of these words, tell how far at most any match can extend to the right (and to the left).
    3. Surroundings that two documents share are certain. Of the others each extension to min_words within those bounds is
       tested for a second document. Both compare 64-bit hashes of all the words, taken from the texts.

    Equal suffixes with equal surroundings count as one before sorting, and range partitions split a frequent core by its
    surroundings, so copies make no partition large. Texts below min_words words, empty texts, and rows with a null id or
    text give no row. Rows that share an id count as one document. Other columns are ignored.
    """
    core, reach = min_words - window + 1, window - 1
    if core < GRAM:
        raise ValueError(f"window must leave a core of {GRAM} words")
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))
    kept = materialise(suffixes(rows, core, window), "suffixes")
    again = materialise(kept.groupBy("sig").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("sig"), "cores")
    by_doc = kept.join(small_side(again), "sig", "left_semi").groupBy("doc_id").agg(F.collect_set(F.struct("pos", "sig")).alias("kept"))
    around = contexts(rows.join(by_doc, "doc_id").select("doc_id", "raw", "kept"), core, reach)
    around = materialise(around, "contexts")

    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    once = around.groupBy("sig", "context").agg(F.first("left").alias("left"), F.first("right").alias("right"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.min(F.struct("doc_id", "pos")).alias("at"))
    for order, name in ((["sig", "right", "left"], "to_right"), (["sig", "left", "right"], "to_left")):
        schema = once.schema.add(name, T.IntegerType())
        once = materialise(once.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_neighbours(order, reach, name), schema), name)

    words = lambda c: (F.octet_length(c) / 2).cast("int")
    whole = F.col("a") != F.col("b")
    bounds = [(F.lit(reach) - F.least("to_right", words("right"))).alias("least"), F.least("to_left", words("left")).alias("most")]
    tried = once.select("sig", "context", "a", "b", "at", *bounds).where("least <= most")
    tried = tried.groupBy(F.col("at.doc_id").alias("doc_id")).agg(F.collect_list(F.struct("at.pos", "sig", "context", "a", "b", "least", "most")).alias("kept"))
    tried = materialise(passages(rows.join(tried, "doc_id").select("doc_id", "raw", "kept"), core, reach), "passages")
    shared = tried.groupBy("passage").agg(F.min("a").alias("x"), F.max("b").alias("y")).where("x <> y").select("passage")
    parts_of = tried.where("a = b").join(shared, "passage", "left_semi").groupBy("sig", "context").agg(F.min("l").alias("least"), F.max("l").alias("most"))
    sure = once.where(whole).select("sig", "context", (F.lit(reach) - words("right")).alias("least"), words("left").alias("most")).where("least <= most")
    ends = parts_of.unionByName(sure)
    found = around.select("sig", "context", "doc_id", "pos").join(ends, ["sig", "context"])
    span = F.struct((F.col("pos") - F.col("most")).alias("start"), (F.col("pos") - F.col("least") + min_words).alias("stop"))
    merged = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(span)).alias("spans")).withColumn("spans", merge_spans(F.col("spans")))
    total = F.aggregate("spans", F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    return merged.select("doc_id", total.alias("n_repeated"), "spans")


def merge_spans(spans: Column) -> Column:
    """Sorted (start, stop) structs with overlapping and touching ones joined."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def add(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        meets = (F.size(done) > 0) & (last["stop"] >= s["start"])
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, empty, add)
