"""Phrase collocations from a weighted de Bruijn graph of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from pixelloom.llm.common import materialise, passing, small_side

#: Edges at most in one row of a compacted path; a longer one continues in another row.
PATH_EDGES = 4096
#: Bytes of text that a task takes apart at a time; a longer text is taken alone.
CHUNK_BYTES = 2 << 20
#: Grams are counted by hashes of so many bits. Those that are frequent set a bit in a table of 2^TABLE_BITS bits,
#: which every task holds. A bit set by another one too costs work, not truth.
HASH_BITS, TABLE_BITS = 40, 27
PAGE = 4096
# Pieces of a text end at these, words at blanks and tabs.
PIECE_END, BLANK = b".,;:!?\n\x0b\x0c\r", b" \t"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PIECE_END, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(PIECE_END))


def words_of(gram: str | Column, k: int | Column) -> Column:
    """The first k words of a gram, whose words a blank parts; the last ones if k is negative."""
    return F.call_function("substring_index", F.col(gram) if isinstance(gram, str) else gram, F.lit(" "), F.lit(k))


class Words:
    """The words of some texts in a row: numbers into a list of distinct words, with their language and the words left in their piece."""

    def __init__(self, langs: list[str | None], texts: list[bytes | None]):
        words: list[bytes] = []
        ends, lang_ends = [], []
        for raw in texts:
            for piece in (raw or b"").translate(_LOWER).split(b"\n"):
                words += piece.split()
                ends.append(len(words))
            lang_ends.append(len(words))
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.ids, self.words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        del words, coded
        self.langs = sorted({x or "und" for x in langs})
        number = {x: i for i, x in enumerate(self.langs)}
        counts = np.diff(np.array([0, *lang_ends]))
        self.lang = np.repeat(np.array([number[x or "und"] for x in langs], np.int64), counts)
        ends = np.array(ends, np.int64)
        self.left = ends[np.searchsorted(ends, np.arange(len(self.ids)), side="right")] - np.arange(len(self.ids)) if len(self.ids) else np.zeros(0, np.int64)

    def hashes(self, words: int) -> list[np.ndarray]:
        """For 1 to ``words`` words from each on, with their language, a hash; of no use where a piece ends before."""
        h = np.array([xxh64_intdigest(w) for w in self.words.to_pylist()], np.uint64)[self.ids]
        lang = np.array([xxh64_intdigest(x.encode()) for x in self.langs], np.uint64)[self.lang]
        out, chain = [], np.zeros(len(h), np.uint64)
        for i in range(words):
            chain = chain * np.uint64(0x9E3779B97F4A7C15) + np.roll(h, -i)
            x = chain * np.uint64(0xC2B2AE3D27D4EB4F) ^ lang
            x ^= x >> np.uint64(29)
            out.append((x * np.uint64(0x165667B19E3779F9) >> np.uint64(64 - HASH_BITS)).astype(np.int64))
        return out

    def grams(self, start: np.ndarray, m: int) -> pa.RecordBatch:
        """(lang, gram, size, c) of the grams of m words from each of start on."""
        key, room = self.lang[start], len(self.langs)
        for i in range(m):
            if room * len(self.words) >= 1 << 62:
                values, key = np.unique(key, return_inverse=True)
                room = len(values)
            key, room = key * len(self.words) + self.ids[start + i], room * len(self.words)
        first, n = np.unique(key, return_index=True, return_counts=True)[1:]
        first = start[first]
        parts = [self.words.take(pa.array(self.ids[first + i])) for i in range(m)]
        gram = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if m else pa.array([b""] * len(n), pa.binary())
        lang = pa.array(self.langs, pa.string()).take(pa.array(self.lang[first]))
        return pa.RecordBatch.from_arrays([lang, gram, pa.array(np.full(len(n), m, np.int32)), pa.array(n)], names=["lang", "gram", "size", "c"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for b in batches:
        langs, texts, size = [], [], 0
        for lang, raw in zip(b.column(0), b.column(1), strict=True):
            lang, raw = lang.as_py(), raw.as_py()
            langs.append(lang)
            texts.append(raw)
            size += len(raw or b"")
            if size >= CHUNK_BYTES:
                yield Words(langs, texts)
                langs, texts, size = [], [], 0
        if texts:
            yield Words(langs, texts)


def frequent(texts: DataFrame, words: int, min_count: int) -> Broadcast:
    """A table of bits of all grams of 1 to ``words`` words, by language, that occur min_count times, and of few others. texts: (lang, raw)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _chunks(batches):
            h, n = np.unique(np.concatenate([x[w.left > i] for i, x in enumerate(w.hashes(words))]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for bits in b.column(1).to_pylist():
                page = np.zeros(PAGE, np.uint8)
                page[bits] = 1
                out.append(np.packbits(page, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["page", "bits"])

    often = texts.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    at = F.pmod("h", F.lit(1 << TABLE_BITS))
    paged = often.select(F.floor(at / PAGE).cast("int").alias("page"), F.pmod(at, F.lit(PAGE)).cast("int").alias("bit"))
    found = paged.groupBy("page").agg(F.collect_set("bit").alias("bits")).mapInArrow(pages, "page int, bits binary").toArrow()  # 2^TABLE_BITS bits at most
    table = np.zeros((1 << TABLE_BITS) // 8, np.uint8)
    for page, bits in zip(found.column("page").to_pylist(), found.column("bits").to_pylist(), strict=True):
        table[page * PAGE // 8 : (page + 1) * PAGE // 8] = np.frombuffer(bits, np.uint8)
    return texts.sparkSession.sparkContext.broadcast(table)


def edges(docs: DataFrame, words: int, min_count: int = 1, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, size, c): how often each gram of ``words`` words occurs, an edge of the graph, and corrections.

    Every occurrence of a word counts once, in the gram that starts there. Where its piece ends before the gram is full,
    the shorter gram, size < words, is the correction for the counts of its nodes. So it is where the next word would make
    a gram that occurs fewer than min_count times: such nodes and edges are contracted, which keeps the flow of all others
    whole; a gram of size 0 counts the contracted words. Counts are summed in each task first; what is frequent is found by
    a pass over the texts before, which counts hashes of all grams.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("raw"))
    often = frequent(texts, words, min_count) if min_count > 1 else None

    def known(h: np.ndarray) -> np.ndarray:
        at = h & ((1 << TABLE_BITS) - 1)
        return (often.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _chunks(batches):
            size, on = np.zeros(len(w.ids), np.int64), np.ones(len(w.ids), bool)
            for i, h in enumerate(w.hashes(words) if often is not None else [None] * words):
                on = on & (w.left > i)
                on = on & known(h) if h is not None else on
                size += on
            for m in range(words + 1):
                yield w.grams(np.flatnonzero(size == m), m)

    counted = texts.mapInArrow(grams, "lang string, gram binary, size int, c long").select("lang", F.col("gram").cast("string").alias("gram"), "size", "c")
    return counted.groupBy("lang", "gram", "size").agg(F.sum("c").alias("c"))


def shorter(grams: DataFrame, k: int) -> DataFrame:
    """(lang, gram, size, c) for grams of at most k words, from those of at most k + 1.

    A node's count is the flow of the edges that leave it, with the pieces that end at it.
    """
    head = F.when(F.col("size") > k, words_of("gram", k)).otherwise(F.col("gram")).alias("gram")
    return grams.select("lang", head, F.least("size", F.lit(k)).alias("size"), "c").groupBy("lang", "gram", "size").agg(F.sum("c").alias("c"))


def paths(heavy: DataFrame, words: int) -> DataFrame:
    """(lang, part, w, c): the graph of the edges heavy (lang, gram, c) with its unary paths compacted.

    A node with one edge in and one out joins them. Each edge finds the head of its path and its distance from it by
    pointer doubling, rounds growing with the logarithm of the longest path, and the edges of a head make one row: w, its
    words, and c, the count of the edge from each word on. Paths longer than PATH_EDGES take several rows, numbered by
    part, which share all but one word of an edge. Edges of a cycle without a way in stay single.
    """
    e = heavy.select("lang", "gram", "c", words_of("gram", words - 1).alias("tail"), words_of("gram", 1 - words).alias("head"))
    into = e.groupBy("lang", F.col("head").alias("tail")).agg(F.count("*").alias("n_in"), F.min("gram").alias("before"))
    out = e.groupBy("lang", "tail").agg(F.count("*").alias("n_out"))
    unary = into.join(out, ["lang", "tail"]).where("n_in = 1 AND n_out = 1").select("lang", "tail", "before")
    state = e.join(unary, ["lang", "tail"], "left").select("lang", "gram", "c", F.coalesce("before", "gram").alias("up"), F.col("before").isNotNull().cast("long").alias("far"))
    state = materialise(state, "paths").withColumn("done", F.col("far") == 0)
    open_ = -1
    while (left := state.where("NOT done").count()) not in (0, open_):
        open_ = left
        above = state.select("lang", F.col("gram").alias("up"), F.col("up").alias("up2"), F.col("far").alias("far2"), F.col("done").alias("done2"))
        moved = state.where("NOT done").join(above, ["lang", "up"]).select("lang", "gram", "c", F.col("up2").alias("up"), (F.col("far") + F.col("far2")).alias("far"), F.col("done2").alias("done"))
        state = materialise(state.where("done").unionByName(moved), "paths")
    state = state.select("lang", "gram", "c", F.when(F.col("done"), F.col("up")).otherwise(F.col("gram")).alias("up"), F.when(F.col("done"), F.col("far")).otherwise(0).alias("far"))
    rows = state.groupBy("lang", "up", F.floor(F.col("far") / PATH_EDGES).alias("part")).agg(F.array_sort(F.collect_list(F.struct("far", "gram", "c"))).alias("e"))
    ends = F.transform(F.slice("e", F.lit(2), F.greatest(F.size("e") - 1, F.lit(0))), lambda x: words_of(x["gram"], -1))
    return rows.select("lang", "part", F.concat(F.split(F.col("e")[0]["gram"], " "), ends).alias("w"), F.transform("e", lambda x: x["c"]).alias("c"))


def inside(found: DataFrame, words: int) -> DataFrame:
    """(lang, gram, most): for each gram of 2 words or more that lies in a longer one, the largest count among these.

    found: (lang, w, c), paths of edges of ``words`` words, or single grams. Within a path the counts around a gram are at hand.
    """

    def of(m: int) -> Column:
        def gram(i: Column) -> Column:
            since = F.greatest(i - (words - m), F.lit(1))
            return F.struct(F.array_join(F.slice("w", i, m), " ").alias("gram"), F.array_max(F.slice("c", since, F.least(i, F.size("c")) - since + 1)).alias("most"))

        return F.transform(F.sequence(F.lit(1), F.size("w") - m + 1), gram)

    parts = [of(m) for m in range(2, words)]
    every = found.select("lang", F.explode(F.concat(*parts)).alias("g")).select("lang", "g.gram", "g.most")
    return every.groupBy("lang", "gram").agg(F.max("most").alias("most"))


def collocations(docs: DataFrame, min_count: int = 10, words: int = 3, top: int = 2000, share: int = 50, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``words`` words of each language.

    Texts are lower-cased (A-Z), split into pieces and words; everything is counted per lang, null as ``und``. Grams of
    ``words`` words are edges between nodes of one word less. Edge counts, and the corrections for pieces that end, are
    aggregated once, with grams rarer than min_count contracted; all shorter counts follow from them, by the flow of each
    node. Edges with at least min_count occurrences make the graph whose unary paths are compacted; a phrase drops out if a longer candidate around it has at
    least share percent of its count, which is read off the paths.

    score: floor(1,000,000 a² / (l r)) of the cut that makes it least (ties: the first), in decimals of 38 digits. Order:
    score, a, then phrase by its bytes. Null and empty texts have no words; very long texts are read whole; repeated rows
    count again; an empty table gives no rows. Columns besides lang and text are ignored, whatever their names.
    """
    if words < 2:
        raise ValueError("phrases have two words or more")
    with passing(docs.sparkSession):
        levels = {words: materialise(edges(docs, words, min_count, lang_col, text_col), "edges")}
        for k in range(words - 1, 0, -1):
            levels[k] = materialise(shorter(levels[k + 1], k), "counts")
        total = materialise(levels[1].groupBy("lang").agg(F.sum("c").alias("n")), "totals")
        often = {k: g.where((F.col("size") == k) & (F.col("c") >= min_count)).select("lang", "gram", "c") for k, g in levels.items()}
        heavy = materialise(often[words], "heavy")
        candidates = heavy.withColumn("m", F.lit(words))
        for k in range(2, words):
            candidates = candidates.unionByName(often[k].withColumn("m", F.lit(k)))
        candidates = materialise(candidates, "candidates")
        around = inside(paths(heavy, words), words) if words > 2 else None
        for k in range(3, words):
            around = around.unionByName(inside(often[k].select("lang", F.split("gram", " ").alias("w"), F.array("c").alias("c")), k))
        if around is not None:
            around = around.groupBy("lang", "gram").agg(F.max("most").alias("most"))
            candidates = candidates.join(around, ["lang", "gram"], "left").where(F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(share) * F.col("c"))).drop("most")
        counts = often[1]
        for k in range(2, words):
            counts = counts.unionByName(often[k])
        counts = small_side(materialise(counts, "parts"))
        cuts = F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - 1), lambda k: F.struct(k.alias("k"), words_of("gram", k).alias("x"), words_of("gram", k - F.col("m")).alias("y"))))
        cut = candidates.select("lang", "gram", F.col("c").alias("a"), cuts.alias("cut")).select("lang", "gram", "a", "cut.*")
        cut = cut.join(counts.select("lang", F.col("gram").alias("x"), F.col("c").alias("l")), ["lang", "x"]).join(counts.select("lang", F.col("gram").alias("y"), F.col("c").alias("r")), ["lang", "y"])
        whole = cut.withColumn("score", F.expr("CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"))
        worst = whole.groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", F.col("gram").alias("phrase"), "a", "s.l", "s.r", "s.score")
        by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = worst.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
        best = best.join(F.broadcast(total), "lang")  # a row for each language that has phrases, of at most top rows each
        return materialise(best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations", keep=True)
