"""Jobs moved by their reports: the stream, restarted after every part, gives what the fold of the whole table gives."""

import itertools
import random
import uuid

import pytest
from pyspark.sql import functions as F

from pixelloom.operators import jobs
from pixelloom.streaming import jobs as streams

REPORT = "id long, s long, status string, reason string, downloaded boolean"


def reports(spark, rows):
    return spark.createDataFrame(rows, REPORT).select("id", F.timestamp_seconds("s").alias("t"), "status", "reason", "downloaded")


def made(n, seed=0):
    r = random.Random(seed)
    kinds = ["queued", "running", "finished", "finished", "finished", "error", "canceled"]
    return [(r.randrange(40), s, r.choice(kinds), r.choice([None, None, None, "OOM"]), r.choice([True, False, False, None])) for s in range(n)]


def rows(df):
    return sorted((r.id, r.status, r.attempt, r.n_reports, r.t) for r in df.select("id", "status", "attempt", "n_reports", "t").collect())


def test_restarted_stream_equals_the_fold(spark, tmp_path):
    every = made(600)
    source = spark.createDataFrame([], REPORT).select("id", F.timestamp_seconds("s").alias("t"), "status", "reason", "downloaded").schema
    for part in range(3):
        reports(spark, every[part * 200 : part * 200 + 200]).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(source).parquet(f"{tmp_path}/in")
        streams.attempts_stream(stream, 60, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        want = rows(jobs.fold_reports(reports(spark, every[: part * 200 + 200]), 60))
        assert rows(streams.latest_attempts(spark, f"{tmp_path}/out")) == want
    assert {"OOM", "finished"} <= {w[1] for w in want} and max(w[2] for w in want) > 1
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_rules_of_single_values_are_those_of_columns(spark):
    """Every previous status x report x attempt x reason x downloaded x late."""
    cases = list(itertools.product(jobs.ACTIVE, ["running", "finished", "error", "canceled"], range(1, 8), [None, "OOM"], [True, False], [True, False]))
    df = spark.createDataFrame(cases, "p string, r string, a int, e string, d boolean, late boolean")
    state = jobs.next_status(F.col("p"), F.col("r"), F.col("a"), F.col("e"), F.col("d"), F.col("late"))
    got = df.withColumn("state", state).withColumn("n", jobs.next_attempt(F.col("p"), F.col("state"), F.col("a"))).collect()
    for g in got:
        since = 0 if g.p == "downloading" else None
        late = g.late and g.p == "downloading"
        assert streams.move_job((g.p, g.a, since, 0), 1000 if late else 10, g.r, g.e, g.d, 50)[:2] == (g.state, g.n), g


@pytest.mark.parametrize("late,want", [([0, 10, 20, 90, 95, 96], ("finished", 2, 6)), ([0, 10, 20, 30, 35, 36], ("finished", 1, 5))])
def test_late_download_starts_again(spark, late, want):
    """running, finished, not down, not down (late or not), finished, down."""
    kinds = [("running", False), ("finished", False), ("finished", False), ("finished", False), ("finished", want[2] == 5), ("finished", True)]
    got = rows(jobs.fold_reports(reports(spark, [(1, t, k, None, d) for t, (k, d) in zip(late, kinds, strict=True)]), 60))
    assert [g[1:4] for g in got] == [want]


def test_ended_jobs_nulls_and_empty_tables(spark):
    odd = [(1, 0, "error", "OOM", None), (1, 1, "running", None, None), (2, 0, None, None, None), (None, 0, "running", None, None), (3, None, "running", None, None), (4, 5, "running", None, None), (4, 5, "running", None, None)]
    got = rows(jobs.fold_reports(reports(spark, odd), 60))
    assert [g[:4] for g in got] == [(1, "OOM", 1, 1), (4, "running", 1, 2)]
    assert jobs.fold_reports(reports(spark, odd).limit(0), 60).count() == 0
