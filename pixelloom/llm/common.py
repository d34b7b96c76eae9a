"""Shared helpers: scratch folders, small size checks and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

#: Most bytes of a table that may be broadcast, counted before it is; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
#: Bytes of an Arrow batch between Spark and Python where whole texts are sent (see small_batches).
BATCH_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset a local session, as in tests, gets a temporary one; a cluster is an error."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if sc.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_passing: ContextVar[str | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are deleted at the end, but for those with keep; nothing that is still lazy may need the others."""
    folder = scratch_path(spark, "passing")
    token = _passing.set(folder)
    try:
        yield
    finally:
        _passing.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries run inside send rows to Python in batches that end once they have BATCH_BYTES, or as many as are set if fewer.

    Without it a batch has 10,000 rows or 64 MB, which a task holds several times over: in Spark's buffers, in the worker and
    in what the worker returns.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    if int(before.removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors. See passing for keep."""
    spark, folder = df.sparkSession, _passing.get()
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder and not keep else scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int = 0) -> DataFrame:
    """df, which should be materialised, with a hint to broadcast if its rows take at most BROADCAST_BYTES.

    Strings are counted as long as they are, other columns as 16 bytes; row_bytes: what arrays take besides.
    """
    kinds = (StringType, BinaryType)
    width = sum(8 if isinstance(f.dataType, kinds) else 16 for f in df.schema) + 24 + row_bytes
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, kinds)]
    size = df.agg(F.sum(sum(texts, F.lit(width)))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def drop_ids(docs: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of docs whose key isn't in gone (one column ``key``; nulls drop nothing). gone is broadcast only while it is small."""
    gone = materialise(gone.select(key).where(F.col(key).isNotNull()).distinct(), "gone")
    return docs.join(small_side(gone), key, "left_anti").select(*docs.columns)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) long edges by alternating large-star and small-star rounds.

    Returns (node, root), root the smallest node of the component; nodes without edges don't appear.
    Every round is two aggregations and joins on the node, written to the shared checkpoint folder. Nothing but
    a row of checksums reaches the driver. Rounds grow with the logarithm of the longest path.
    """
    shared_dir(edges.sparkSession)
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()

    def seen(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    state = seen(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = small.select(F.col("u"), F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct().checkpoint()
        new = seen(e)
        if new == state:
            break
        state = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
