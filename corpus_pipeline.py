"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing and token shards over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.llm import decontaminate as _decontaminate
from pixelloom.llm import language_id as _language
from pixelloom.llm import mixing as _mixing
from pixelloom.llm import simhash as _simhash
from pixelloom.llm import token_shards as _tokens
from pixelloom.llm.common import materialise, scratch_path, small_batches, small_side

#: Words of a shingle where a stage compares documents.
SHINGLE_WORDS = 5
#: Similarity of the sets of shingles from which documents are near-duplicates.
SIMILARITY = 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language.

    Each row is judged by its own text, lang and source, whatever its id: rows without an id too, and rows that share one
    apart. Null and empty texts have no letters, so they go; long texts are read whole; repeated rows share their fate. An
    empty table stays empty; columns pass through, whatever their names.
    """
    parts = [F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")), *[F.coalesce(docs[c].cast("string"), F.lit("")) for c in ("lang", "source")]]
    key = F.concat_ws("\x00", *parts)
    with small_batches(spark):
        judged = _language.identify(docs.select(key.alias("doc_id"), "text", "lang", "source"), _language.learn(docs), declared=F.col("lang"), host=F.col("source"))
    gone = small_side(materialise(judged.where("NOT accepted").select("doc_id").distinct(), "rejected"))
    return docs.join(gone, key == gone["doc_id"], "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of documents with similar shingles: that with the smallest id.

    Rows are judged by their own text: rows that share an id but not the text can both stay. A row without an id stays
    only if its class has no row with one. Null and empty texts are equal to each other; of rows with the same id and text
    one stays. An empty table stays empty; columns pass through, whatever their names.
    """
    return _simhash.keep_one_of_each(docs, shingle_words=SHINGLE_WORDS, similarity=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item.

    Where several rows share an id, all go if one holds a window. Rows without an id are judged by their own text. Null and
    empty texts hold none and stay; long texts are read whole; repeated rows share their fate. Columns pass through.
    """
    key = F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))))
    found = _decontaminate.decontaminate(docs.select(key.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = small_side(materialise(found.where("contaminated").select("doc_id").distinct(), "contaminated"))
    return docs.join(gone, key == gone["doc_id"], "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture, sources at the square root of their size; the files, in order, are the schedule.

    Null sources form one of their own; null ids are ordered by a hash of the row, ties too; repeated rows each keep a
    place. An empty table stays empty; columns pass through, whatever their names.
    """
    return _mixing.mix(docs, block_rows=64, temperature=0.5)


#: Sequences among which the last stage permutes: the mixture holds from one such window to the next.
WINDOW = 4096


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token shards; a row for each sequence.

    docs are the files that the mixing stage wrote: sequences are numbered in the order of its schedule, and permuted
    within windows of WINDOW. Null and empty texts are an end mark alone; repeated rows are each written; long texts run
    over as many sequences as they take. An empty table gives no rows.
    """
    ordered = docs.select("text", _mixing.file_order().alias("stream"))
    return _tokens.write_shards(ordered, scratch_path(spark, "shards"), stream_col="stream", window=WINDOW)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_shards", token_shards),
]
#: The stages have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
