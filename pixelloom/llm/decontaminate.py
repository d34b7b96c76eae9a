"""Benchmark decontamination: prefix-filtered join of item windows with documents, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelloom.llm.common import materialise, small_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of digits, letters A-Z and characters beyond ASCII; A-Z lower-cased and nothing else. Null has none."""
    text = F.coalesce(text, F.lit(""))
    other_case = (F.octet_length(text) > F.length(text)) & text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")  # letters that lower() would change too
    low = F.when(other_case, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    between = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    inner = F.regexp_replace(low, f"^{between}|{between}$", "")
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, between))


def _codes(w: Column, k: int) -> Column:
    """A hash of every k consecutive words of w; none if there are fewer."""
    code = lambda i: F.xxhash64(F.lit(k), *[F.get(w, i + j) for j in range(k)])
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), code)).otherwise(F.array().cast("array<bigint>"))


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window_words: int = 10, shingle_words: int = 3) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n_words) of each row of docs, and (doc_id, text_hash, start, len, item_id) of each occurrence.

    A window is window_words consecutive words of an item; an item of fewer words, but not none, is one window.
    1. Shingles of documents whose hash some window has are kept, in one scan; nothing else is shuffled.
    2. A window's shingles are ordered by how often the corpus has them. Whole containment needs every one, so a prefix
       of one token, the rarest, finds all candidates.
    3. Position: the window would start as far before the token as the token stands in it. Length: it must fit between
       the first and last word of the document.
    4. A candidate stands if every shingle of the window is at its place, and the words there are those of the window; for
       that the texts with candidates alone are read again.
    """
    if shingle_words not in (1, 2, 3) or window_words < shingle_words:
        raise ValueError("shingles have one to three words and no more than a window")
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window_words, F.lit(0)))
    windows = items.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at") + 1, window_words).alias("w"))
    k_of = F.least(F.size("w"), F.lit(shingle_words))
    need = F.array().cast("array<bigint>")
    for k in range(1, shingle_words + 1):
        need = F.when(k_of == k, _codes(F.col("w"), k)).otherwise(need)
    windows = windows.select("item_id", F.array_join("w", " ").alias("window"), F.size("w").alias("len"), k_of.alias("k"), need.alias("need"))
    windows = materialise(windows.distinct(), "windows")
    ks = sorted(r.k for r in windows.select("k").distinct().collect()) or [shingle_words]  # at most three numbers
    wanted = small_side(materialise(windows.select(F.explode("need").alias("code"), F.lit(True).alias("wanted")).distinct(), "wanted"))

    held = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    scans = []
    for k in ks:
        row = F.array(F.lit(None).cast("bigint")) if k == ks[0] else F.array().cast("array<bigint>")  # stands for the row itself
        coded = held.select("doc_id", "text_hash", F.size("w").alias("n_words"), F.posexplode_outer(F.concat(row, _codes(F.col("w"), k))).alias("pos", "code"))
        scans.append(coded.withColumn("pos", F.col("pos") - F.lit(1 if k == ks[0] else 0)))
    found = reduce(DataFrame.unionByName, scans).join(wanted, "code", "left").where("wanted OR pos = -1").drop("wanted")
    found = materialise(found, "shingles")

    rows = found.where("pos = -1").select("doc_id", "text_hash", "n_words")
    hits = found.where("pos >= 0").distinct()
    rarity = hits.groupBy("code").agg(F.count("*").alias("n"))
    tokens = windows.select("item_id", "window", "len", "need", F.posexplode("need").alias("pos", "code"))
    tokens = tokens.join(rarity, "code", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    first = Window.partitionBy("item_id", "window").orderBy("n", "pos")
    prefix = tokens.withColumn("o", F.row_number().over(first)).where("o = 1 AND n > 0").select("item_id", "window", "len", "need", F.col("pos").alias("offset"), "code")
    prefix = small_side(materialise(prefix, "prefix"), row_bytes=16 * window_words)

    near = Window.partitionBy("doc_id", "text_hash").orderBy("pos").rangeBetween(-window_words, window_words)
    around = hits.withColumn("near", F.collect_list(F.struct("pos", "code")).over(near))
    candidates = around.join(prefix, "code").withColumn("start", F.col("pos") - F.col("offset"))
    candidates = candidates.where("start >= 0 AND start + len <= n_words")
    placed = F.transform("need", lambda c, i: F.struct((i + F.col("start")).alias("pos"), c.alias("code")))
    candidates = candidates.where(F.size(F.array_except(placed, F.col("near"))) == 0)
    candidates = materialise(candidates.select("doc_id", "text_hash", "start", "len", "item_id", "window"), "candidates")

    again = small_side(materialise(candidates.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).distinct(), "again"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    texts = texts.join(again, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))).dropDuplicates(["d", "h"]).select("d", "h", words(F.col("text")).alias("w"))
    sure = candidates.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    sure = sure.where(F.array_join(F.slice("w", F.col("start") + 1, F.col("len")), " ") == F.col("window"))
    return rows, sure.select("doc_id", "text_hash", "start", "len", "item_id")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window_words: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of docs.

    n_hit counts words inside any occurrence of a window, each once. items_sha256 is of the comma-joined item ids,
    sorted as strings; with no item, of the empty string. Null and empty texts have no words. Rows with the same doc_id
    and text repeat their result; rows that share a doc_id but not the text have their own. An item with a null id is
    matched and counted in n_hit, not in n_items. With an empty benchmark nothing is hit. Other columns are ignored.
    """
    rows, spans = contaminated_spans(docs, benchmark, window_words)
    by_doc = spans.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("stop")))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    zero = F.struct(F.lit(0).alias("stop"), F.lit(0).cast("long").alias("n"))

    def cover(acc: Column, s: Column) -> Column:
        stop = F.greatest(acc["stop"], s["stop"])
        return F.struct(stop.alias("stop"), (acc["n"] + (stop - F.greatest(acc["stop"], s["start"]))).cast("long").alias("n"))

    by_doc = by_doc.select("d", "h", F.aggregate("spans", zero, cover)["n"].alias("n_hit"), "items")
    out = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
