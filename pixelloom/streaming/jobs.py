"""Structured Streaming jobs: period composites, job status, attempts of jobs, first sights of items."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pixelloom.operators import jobs, temporal


def composite_stream(observations: DataFrame, bands: Sequence[str], period: str, reducer: str, store: str, out: str, checkpoint: str) -> StreamingQuery:
    """Keep composites of arriving observations up to date.

    Each batch is stored under its number (so a repeated batch replaces itself), the (pixel, period) keys that it touches
    are recomputed from all stored observations of their periods, and the result is written as a new version of those
    periods. Exact for every reducer, the median included.
    """

    def update(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("period", temporal.period_start(F.col("t"), period))
        rows.withColumn("batch", F.lit(number)).write.partitionBy("batch", "period").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(store)
        touched = rows.select("x", "y", "period").distinct()
        periods = [r.period for r in rows.select("period").distinct().collect()]  # as few as a batch spans
        stored = spark.read.parquet(store).where((F.col("batch") <= number) & F.col("period").isin(periods))  # other folders aren't listed
        again = stored.join(touched, ["x", "y", "period"], "left_semi").select("x", "y", "t", *bands)
        new = temporal.composite(again, bands, period, reducer).withColumn("batch", F.lit(number))
        new.write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(out)

    return observations.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_composites(spark: SparkSession, out: str, bands: Sequence[str]) -> DataFrame:
    """The newest version of every (x, y, t)."""
    rows = spark.read.parquet(out)
    return rows.groupBy("x", "y", "t").agg(F.max_by(F.struct(*bands), "batch").alias("v")).select("x", "y", "t", *[F.col(f"v.{b}").alias(b) for b in bands])


def status_stream(events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Latest status, its time and the number of reports of each job; each batch writes the jobs that it changed as a version under out."""
    latest = events.groupBy("id").agg(F.max_by("status", F.struct("t", "status")).alias("status"), F.max("t").alias("t"), F.count("*").alias("n_reports"))

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(out)

    return latest.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_status(spark: SparkSession, out: str) -> DataFrame:
    """The newest version of every job."""
    rows = spark.read.parquet(out).groupBy("id").agg(F.max_by(F.struct("status", "t", "n_reports"), "batch").alias("v"))
    return rows.select("id", "v.status", "v.t", "v.n_reports")


def move_job(job: tuple[str, int, int | None, int], t: int, reported: str, reason: str | None, downloaded: bool, limit: int) -> tuple[str, int, int | None, int]:
    """(status, attempt, start of the download, reports) of a job after one more report: the rules of jobs.fold_reports for single values."""
    previous, attempt, since, n = job
    if previous not in jobs.ACTIVE:
        return job
    loading = not downloaded if previous == "downloading" else False
    loading = loading or (reported == "finished" and previous != "downloading")
    late = since is not None and t - since > limit * attempt
    if loading and previous == "downloading" and late:
        status = "running" if attempt <= jobs.MAX_ATTEMPTS + 2 else "error_downloading"
    elif loading:
        status = "downloading"
    elif reported == "error":
        status = reason or ("not_started" if attempt <= jobs.MAX_ATTEMPTS else "error_openeo")
    elif reported == "canceled" and attempt <= jobs.MAX_ATTEMPTS:
        status = "not_started"
    else:
        status = reported
    if status == "not_started" or (previous == "downloading" and status == "running"):
        attempt += 1
    begun = (since if previous == "downloading" else t) if status == "downloading" else None
    return status, attempt, begun, n + 1


class JobReports(StatefulProcessor):
    """Moves each job by the reports of a batch, in the order of time; its state is dropped when no report has come for the time to live."""

    def __init__(self, limit: int, live_ms: int | None):
        self.limit, self.live_ms = limit, live_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.job = handle.getValueState("job", "status string, attempt int, since long, n_reports long, t long", self.live_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        reports = sorted((int(r.t), r.status, r.reason or "", bool(r.downloaded)) for part in rows for r in part.itertuples())
        known = self.job.get()
        job, last = (tuple(known)[:4], known[4]) if known is not None else (("created", 1, None, 0), None)
        for t, status, reason, downloaded in reports:
            if last is not None and t < last:
                continue
            moved = move_job(job, t, status, reason or None, downloaded, self.limit)
            job, last = moved, t if moved is not job else last
        self.job.update((*job, last))
        yield pd.DataFrame({"id": [key[0]], "status": [job[0]], "attempt": [job[1]], "n_reports": [job[3]], "t": [last]})

    def close(self) -> None:
        pass


def attempts_stream(reports: DataFrame, limit_s: float, out: str, checkpoint: str, live_ms: int | None = None) -> StreamingQuery:
    """Status and attempts of jobs from arriving reports (id, t, status, reason, downloaded), as jobs.fold_reports has them for a whole table.

    The state is one small row a job, in a state store on the shared checkpoint: a restarted stream goes on where it
    was. Reports of one batch are put in order; one that comes in a later batch than a newer one of its job changes
    nothing. Without live_ms the stream ends when all there is has been read. With it, a job that hasn't been reported for
    so long is dropped from the state, and the stream runs until it is stopped, as it has time to watch. Each batch writes the jobs that it changed as a
    version under out.
    """
    spark = reports.sparkSession
    kind = T.StructType([T.StructField("id", reports.schema["id"].dataType)]).add("status", "string").add("attempt", "integer").add("n_reports", "long").add("t", "long")
    moved = jobs.clean_reports(reports).groupBy("id").transformWithStateInPandas(JobReports(int(limit_s * 1_000_000), live_ms), kind, "update", "ProcessingTime" if live_ms else "None")

    def store(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("t", F.timestamp_micros("t")).withColumn("batch", F.lit(number))
        rows.write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(out)

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    when = {"processingTime": "10 seconds"} if live_ms else {"availableNow": True}
    spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return moved.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**when).start()
    finally:
        spark.conf.set(setting, before)


def latest_attempts(spark: SparkSession, out: str) -> DataFrame:
    """The newest version of every job."""
    rows = spark.read.parquet(out).groupBy("id").agg(F.max_by(F.struct("status", "attempt", "n_reports", "t"), "batch").alias("v"))
    return rows.select("id", "v.*")


def first_items(items: DataFrame, keys: Sequence[str], late: str = "2 days") -> DataFrame:
    """The first sight of each key; state is dropped once the watermark has passed it."""
    return items.withWatermark("t", late).dropDuplicatesWithinWatermark(list(keys))
