"""Near-duplicate classes: by SimHash and meet-in-the-middle ball hashing, and by an exact join of sets of shingles."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from pixelloom.llm.common import components, materialise, passing, small_batches, small_side

SEED = 42


def fingerprint(raw: bytes | None, shingle_words: int) -> int:
    """64-bit SimHash, as a signed number, of UTF-8 text; A-Z lower-cased, words split at ASCII white space."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    h = np.array([xxh64_intdigest(s, SEED) for s in shingles], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp bigint): one row for each input row; null and wordless texts get 0. Other columns are ignored."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(x.as_py(), shingle_words) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("raw")).mapInArrow(run, schema)


def ball(half: int) -> list[int]:
    """XOR masks of at most half bits, as signed 64-bit numbers."""
    masks = [sum(1 << b for b in bits) for n in range(half + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(nodes: DataFrame, max_distance: int = 2) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints (column fp) at most max_distance (even) bits apart.

    Each fingerprint emits all variants within max_distance / 2 bits. Two linked fingerprints share a variant, and all
    that share one are linked; so an edge from each to the least one of the variant keeps every class whole without
    listing pairs. A variant has at most as many fingerprints as the ball has masks (65 at distance 2), however many
    documents there are, so no group is hot.
    """
    if max_distance % 2:
        raise ValueError("max_distance must be even")
    masks = F.array(*[F.lit(m) for m in ball(max_distance // 2)])
    posted = nodes.select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    least = F.min("fp").over(Window.partitionBy("variant"))
    pairs = posted.select("fp", least.alias("b")).where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)


def near_duplicate_classes(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every input row.

    fingerprint: 16 lower-case hex digits. component_id: the smallest doc_id that links reach. Copies are folded into
    one fingerprint before anything is shuffled. Null and empty texts have fingerprint zero and are linked like any
    other; a null doc_id keeps its row and never becomes a component_id unless its class has no other. Repeated rows
    each return a row. An empty table gives no rows. Columns besides id and text are ignored, whatever their names.
    """
    fps = materialise(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(nodes.select("fp"), max_distance))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Texts at most whose shingles set the order that all texts are read in, and shingles at most that it names. Both bear on
#: speed alone: any order gives every pair.
ORDER_TEXTS, ORDER_SHINGLES = 20_000, 100_000
#: A shared shingle whose texts need more comparisons than the square of this is set aside for a longer look.
CROWD = 24
#: How many earlier shared shingles of a text are looked at, so that a pair with many in common is listed once or a few times.
EARLIER = 12
#: Words of a shingle of the fingerprints that propose pairs first.
FINGERPRINT_WORDS = 3
#: Bits at least of the parity sketch that rules out pairs before whole sets are compared; long texts have more.
SKETCH = 1024


def shingle_set(raw: bytes | None, shingle_words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; a text of fewer words is one shingle."""
    words = raw.lower().split() if raw else []
    several = set(map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))) or {b" ".join(words)}
    return np.sort(np.array([xxh64_intdigest(s, SEED) for s in several], dtype=np.uint64))


def sketch_bits(n: int) -> int:
    """A power of two: SKETCH, and twice the n elements at least, as a sketch that is full of bits rules out nothing."""
    return max(SKETCH, 1 << (2 * n - 1).bit_length())


def sketch(h: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """For each residue of bits, a power of two, whether an odd number of hashes has it, as 64-bit numbers.

    Each element that one of two sets has and the other hasn't turns one bit, so sketches differ in no more bits than the
    sets in elements; a longer one is folded to the length of a shorter one by XOR of its parts (see _apart).
    """
    odd = np.bincount((h % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _apart(x: str, y: str) -> Column:
    """The bits in which two sketches differ, the longer one folded to the length of the shorter."""
    words = F.least(F.size(x), F.size(y))

    def folded(c: str) -> Column:
        parts = lambda i: F.aggregate(F.sequence(i, F.size(c) - 1, words), F.lit(0).cast("long"), lambda s, at: s.bitwiseXOR(F.get(c, at)))
        return F.when(F.size(c) == words, F.col(c)).otherwise(F.transform(F.sequence(F.lit(0), words - 1), parts))

    return F.aggregate(F.zip_with(folded(x), folded(y), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, d: n + d)


def prefix_length(n: int, similarity: float) -> int:
    """How many of the n elements, in an order that all sets share, must hold one of any similar set."""
    return n - math.ceil(similarity * n - 1e-9) + 1


class Order:
    """An order of all shingles: common ones come last, the most common at the very end; others by their hash."""

    def __init__(self, common: dict[int, int]):
        self.keys = np.sort(np.array(list(common), dtype=np.uint64))
        self.counts = np.array([common[int(k)] for k in self.keys], dtype=np.int64)

    def first(self, h: np.ndarray, n: int) -> np.ndarray:
        """The first n of the sorted hashes h."""
        if not len(self.keys):
            return h[:n]
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        count = np.where(self.keys[at] == h, self.counts[at], 0)
        return h[np.argsort(count, kind="stable")[:n]]


def _node() -> Column:
    return F.xxhash64(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _texts(docs: DataFrame, copies: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(node, raw): docs without the rows that repeat the text of another; copies has (same, first_id) of repeated texts.

    wanted: a column node; only these texts are read on, before they meet copies.
    """
    joined = docs.select("doc_id", _node().alias("node"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))
    if wanted is not None:
        joined = joined.join(small_side(wanted), "node", "left_semi")
    joined = joined.join(small_side(copies), F.col("node") == F.col("same"), "left")
    return joined.where("same IS NULL OR doc_id <=> first_id").select("node", "raw")


def learn_order(texts: DataFrame, shingle_words: int, n_texts: int) -> Order:
    """The order by the counts of shingles in at most about ORDER_TEXTS of n_texts texts, chosen by a hash."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_set(x.as_py(), shingle_words) for x in b.column(0)]
            if found:
                key, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    share = int(1_000_000 * min(1.0, ORDER_TEXTS / max(1, n_texts)))
    some = texts.where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < share).select("raw")
    counts = some.mapInArrow(shingles, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n >= 3")
    found = counts.orderBy(F.desc("n"), "key").limit(ORDER_SHINGLES).toArrow()
    return Order(dict(zip(found.column("key").to_numpy().view(np.uint64).tolist(), found.column("n").to_pylist(), strict=True)))


def posts(texts: DataFrame, order: Order, shingle_words: int, similarity: float, more: int = 0) -> DataFrame:
    """(node, n, p, sketch, keys) of each text: n shingles, of which the first p + more in order are its keys."""
    sent = texts.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(x.as_py(), shingle_words) for x in b.column(1)]
            p = [prefix_length(len(h), similarity) for h in sets]
            keys = [sent.value.first(h, k + more).view(np.int64) for h, k in zip(sets, p, strict=True)]
            longs = pa.list_(pa.int64())
            columns = [b.column(0), pa.array(map(len, sets), pa.int32()), pa.array(p, pa.int32()), pa.array([sketch(h, sketch_bits(len(h))) for h in sets], longs), pa.array(keys, longs)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "p", "sketch", "keys"])

    return texts.mapInArrow(run, "node long, n int, p int, sketch array<long>, keys array<long>")


def _ordered(pairs: DataFrame, p: str, q: str) -> DataFrame:
    return pairs.select(F.greatest(f"{p}.node", f"{q}.node").alias("a"), F.least(f"{p}.node", f"{q}.node").alias("b")).distinct()


def _may_fit(p: str, q: str, similarity: float) -> Column:
    """Whether sizes and places in the order allow two texts with a shingle in common to be similar, if it is their first."""
    size = lambda x: F.col(f"{x}.n")
    left = lambda x: F.col(f"{x}.n") - F.col(f"{x}.pos")
    fits = F.least(size(p), size(q)) >= similarity * F.greatest(size(p), size(q)) - 1e-6
    return fits & (F.least(left(p), left(q)) >= similarity / (1 + similarity) * (size(p) + size(q)) - 1e-6)


def fingerprint_pairs(texts: DataFrame, shingle_words: int, max_distance: int = 2) -> DataFrame:
    """Pairs (a, b) of nodes that join all texts whose SimHash fingerprints are linked: each text with the least of its
    fingerprint, and the least of a fingerprint with that of each that ``links`` joins to it.
    """
    fps = materialise(fingerprints(texts, shingle_words, "node", "raw"), "fingerprints").withColumnRenamed("doc_id", "node")
    least = materialise(fps.groupBy("fp").agg(F.min("node").alias("least")), "least")
    own = fps.join(least, "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    side = lambda c, x: least.select(F.col("fp").alias(c), F.col("least").alias(x))
    other = links(least.select("fp"), max_distance).join(side("a", "x"), "a").join(side("b", "y"), "b").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    return own.unionByName(other)


def exact_pairs(read: Callable[[DataFrame], DataFrame], sketches: DataFrame, pairs: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """The (a, b) of pairs whose texts' sets of shingles have at least this Jaccard similarity.

    Sketches (node, n, sketch) of these texts rule out what they can for certain; the texts of the other pairs, and no
    others, are read again. Their sets stay where they are read: each is sent once for every pair that it is the a of, and
    once more if it is the b of any.
    """
    pairs = materialise(pairs, "met")
    if pairs.isEmpty():
        return pairs
    met = materialise(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes-met")
    sketches = sketches.join(small_side(met), "node", "left_semi")
    side = lambda c, n, x: sketches.select(F.col("node").alias(c), F.col("n").alias(n), F.col("sketch").alias(x))
    both = pairs.join(side("a", "na", "x"), "a").join(side("b", "nb", "y"), "b")
    both = both.where(F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-6)
    pairs = materialise(both.where(_apart("x", "y") <= (F.col("na") + F.col("nb")) * ((1 - similarity) / (1 + similarity)) + 1e-6).select("a", "b"), "pairs")
    if pairs.isEmpty():
        return pairs
    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # rows may repeat
        for b in batches:
            new = {node: x for node, x in zip(b.column(0).to_pylist(), b.column(1), strict=True) if node not in seen}
            seen.update(new)
            sets = [shingle_set(x.as_py(), shingle_words).tobytes() for x in new.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.int64()), pa.array(sets, pa.binary())], names=["node", "set"])

    sets = read(wanted).mapInArrow(run, "node long, set binary").withColumn("at", F.monotonically_increasing_id())
    sets = materialise(sets, "sets")
    again = sets.groupBy("node").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1")
    again = materialise(again.select(F.col("node").alias("same"), "first"), "again")
    sets = sets.join(small_side(again), F.col("node") == F.col("same"), "left").where("same IS NULL OR at = first").select("node", "set")
    right = materialise(pairs.select(F.col("b").alias("node")).distinct(), "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(overlap / (len(x) + len(y) - overlap) >= similarity)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = sets.toDF("a", "x").join(small_side(pairs), "a")
    both = left.join(sets.join(small_side(right), "node", "left_semi").toDF("b", "y"), "b").select("a", "b", "x", "y")
    return materialise(both.mapInArrow(compare, "a long, b long"), "close")


def _leaders(shared: DataFrame, similarity: float) -> DataFrame:
    """Pairs of each text with three of every key: the least node, that of a second order of nodes, and the text with the
    fewest rarer shingles for its size, which in a family of edited copies is the one nearest to all others.
    """
    me = F.struct("node", "n", "pos")
    near = F.struct(F.col("rank") / F.col("n"), F.col("node"))
    lead = shared.groupBy("key").agg(F.min(me).alias("l1"), F.min_by(me, F.xxhash64("node")).alias("l2"), F.min_by(me, near).alias("l3"))
    met = shared.join(lead, "key").select(me.alias("p"), F.explode(F.array_distinct(F.array("l1", "l2", "l3"))).alias("q"))
    return _ordered(met.where((F.col("p.node") != F.col("q.node")) & _may_fit("p", "q", similarity)), "p", "q")


def _open(shared: DataFrame, close: DataFrame) -> DataFrame:
    """shared, for keys whose texts are in several classes, with each text's class root and the key's largest class big.

    m: texts of the key; work: its comparisons, of every text outside its largest class with all others.
    """
    rooted = shared.join(components(close), "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rooted.groupBy("key", "root").agg(F.count("*").alias("m"))
    keys = sizes.groupBy("key").agg(F.max_by("root", F.struct("m", "root")).alias("big"), F.max("m").alias("most"), F.sum("m").alias("m"), F.count("*").alias("classes"))
    keys = keys.where("classes > 1").select("key", "big", "m", ((F.col("m") - F.col("most")) * F.col("m")).alias("work"))
    return materialise(rooted.join(keys, "key"), "open")


def _across(open_: DataFrame, similarity: float) -> DataFrame:
    """All pairs of texts that share a key and aren't in one class.

    A pair is left out at a key where one of the EARLIER keys before it is also common to both, as it is listed at that one:
    all keys are in one order, and an earlier place allows more. So the first key that two texts share always lists them.
    """
    before = F.collect_list("key").over(Window.partitionBy("node").orderBy("rank", "key").rowsBetween(-EARLIER, -1))
    open_ = open_.select("key", "node", "n", "pos", "root", "big", before.alias("before"))
    met = F.expr("p.key = q.key AND p.root <> q.root AND (q.root = q.big OR p.node > q.node)") & _may_fit("p", "q", similarity)
    sides = open_.where("root <> big").alias("p").join(open_.alias("q"), met & ~F.arrays_overlap("p.before", "q.before"))
    return _ordered(sides, "p", "q")


def _repeated(posted: DataFrame, *columns: Column) -> DataFrame:
    """(key, node, n, columns, times): the keys that several texts have; columns may use pos, the place of the key in its text."""
    every = posted.select("node", "n", "p", "keys", F.posexplode_outer("keys").alias("pos", "key")).select("key", "node", "n", *columns)
    again = every.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    return every.join(again, "key")


def _longer(read: Callable[[DataFrame], DataFrame], order: Order, crowd: DataFrame, more: int, whole: bool, shingle_words: int, similarity: float) -> DataFrame:
    """Keys of the texts of crowd: of the first p + more shingles the p that the fewest of these texts have.

    Similar sets have more than ``more`` of these first shingles in common, so the rarest of those is among the p of both.
    whole: p + more shingles are all that any of these texts has. Then a key's place among them, after those that no other
    text has and those that fewer have, bounds what two texts can share if it is their first; else its place is 0. The
    order of places is in rank either way.
    """
    found = _repeated(materialise(posts(read(crowd), order, shingle_words, similarity, more).drop("sketch"), "ahead"), F.col("p"), F.size("keys").alias("size"))
    kept = found.groupBy("node", "n", "p", "size").agg(F.array_sort(F.collect_list(F.struct("times", "key"))).alias("keys"))
    alone = F.col("size") - F.size("keys")  # keys that only one text has come first
    rare = kept.select("node", "n", alone.alias("alone"), F.posexplode(F.slice("keys", F.lit(1), F.greatest(F.lit(0), F.col("p") - alone))).alias("i", "k"))
    rank = F.col("alone") + F.col("i")
    return materialise(rare.select(F.col("k.key").alias("key"), "node", "n", (rank if whole else F.lit(0)).alias("pos"), rank.alias("rank")), "longer")


def text_classes(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row, and (node, first_id, rows, root) of every text: classes of similar sets of shingles.

    Exact: two texts are linked if and only if the Jaccard similarity of their sets of shingles is at least
    ``similarity``, and classes are the components of these links.

    0. Texts with linked SimHash fingerprints (of FINGERPRINT_WORDS words, two bits apart at most) are compared.
    1. In an order of all shingles a similar pair has one in common among the first few of each. Texts are compared with
       three texts of each such shingle, which joins families of copies without listing their pairs.
    2. All texts that still share a shingle and aren't in one class are compared with each other, unless so many share it
       that this costs more than CROWD squared comparisons, and all such shingles more than four comparisons a text.
    3. Texts that share so common a shingle look further ahead in the order, which lets them leave out the most common
       ones and meet at rarer ones; and so on, four times as far each time, up to the whole text.

    Rows with equal texts count as one text, null and empty ones as equal.
    """
    with passing(docs.sparkSession), small_batches(docs.sparkSession):
        rows = materialise(docs.select("doc_id", _node().alias("node")), "rows", keep=True)
        nodes = materialise(rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows")), "nodes")
        copies = materialise(nodes.where("rows > 1").select(F.col("node").alias("same"), "first_id"), "copies")
        texts = _texts(docs, copies)
        read = lambda wanted: _texts(docs, copies, wanted)
        n_texts = nodes.count()
        order = learn_order(texts, shingle_words, n_texts)
        posted = materialise(posts(texts, order, shingle_words, similarity), "posted")
        shared = materialise(_repeated(posted, F.col("pos"), F.col("pos").alias("rank")).drop("times"), "shared")
        sketches = posted.select("node", "n", "sketch")
        close = exact_pairs(read, sketches, fingerprint_pairs(texts, FINGERPRINT_WORDS), shingle_words, similarity)
        close = close.unionByName(exact_pairs(read, sketches, _leaders(shared, similarity), shingle_words, similarity))
        more = 0
        while True:
            open_ = _open(shared, close)
            crowd = open_.where(F.col("work") > CROWD**2)
            crowd = materialise(crowd.groupBy("node").agg(F.max("n").alias("n"), F.sum(F.col("work") / F.col("m")).alias("work")), "crowd")
            longest, work = crowd.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("work"), F.lit(0.0))).first()
            last = more >= longest or work <= 4 * n_texts  # no text could look further, or none need to
            now = open_ if last else open_.where(F.col("work") <= CROWD**2)
            close = close.unionByName(exact_pairs(read, sketches, _across(now, similarity), shingle_words, similarity))
            if last:
                break
            more = 4 * more or 64
            shared = _longer(read, order, crowd.select("node"), more, more >= longest, shingle_words, similarity)
            close = close.unionByName(exact_pairs(read, sketches, _leaders(shared, similarity), shingle_words, similarity))
        rooted = nodes.join(components(close), "node", "left").withColumn("root", F.coalesce("root", "node"))
        return rows, materialise(rooted, "classes", keep=True)


def similar_classes(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) for every row of docs: classes of documents whose sets of shingles are similar (see text_classes).

    Rows with equal texts count as one. component_id: the smallest doc_id that links reach. Texts without words form a
    class; null ids keep their rows. Other columns are ignored; an empty table gives no rows.
    """
    rows, classes = text_classes(docs, shingle_words, similarity)
    ids = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = classes.join(ids, "root").select("node", "component_id")
    return rows.join(named, "node").select("doc_id", "component_id")


def keep_one_of_each(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of docs, one of each class of similar texts, with the columns of docs.

    Of a class the row with the smallest doc_id stays (of equal ids that with the smallest text hash; a row without an id
    only if no row of the class has one). Of rows with equal id and text one stays. Rows are judged by their own text, so
    rows that share an id but not the text can both stay.
    """
    rows, classes = text_classes(docs, shingle_words, similarity)
    best = classes.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("best"))
    kept = best.select(F.col("best.node").alias("_node"), F.col("best.first_id").alias("_id"))
    counted = rows.groupBy("doc_id", "node").agg(F.count("*").alias("_n"))
    judged = counted.join(kept, F.col("node").eqNullSafe(F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    gone = judged.where("_node IS NULL OR _n > 1").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"), F.col("_node").isNotNull().alias("_again"))
    gone = materialise(gone, "gone")

    def of(side: DataFrame) -> Column:
        own = F.xxhash64(F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))
        return own.eqNullSafe(side["_node"]) & docs["doc_id"].eqNullSafe(side["_id"])

    side = small_side(gone)
    left = docs.join(side, of(side), "left_anti")
    again = materialise(gone.where("_again"), "again")
    if again.isEmpty():
        return left
    side = small_side(again)
    return left.unionByName(docs.join(side, of(side), "left_semi").dropDuplicates(["doc_id", "text"]))
