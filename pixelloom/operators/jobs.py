"""Job tables: splitting points into jobs, building rows, status rules, costs and catalogue checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Points from which a group is split, attempts, price of a credit, catalogue page size.
MAX_POINTS, MAX_ATTEMPTS, PRICE, PAGE = 256, 3, 0.01, 100
# The statuses of jobs that are still asked for, and of those that wait for a new start.
ACTIVE = ("created", "queued", "queued_for_start", "running", "downloading", "not_started")


def with_count(df: DataFrame, key: Column, name: str) -> DataFrame:
    """df with how many rows have the same key (null is one): counts are summed first and joined, so no group of rows meets in one task."""
    counts = df.groupBy(key.alias("_key")).agg(F.count("*").alias(name))
    return df.join(counts, key.eqNullSafe(F.col("_key"))).drop("_key")


def split_jobs(points: DataFrame, tile: str = "grid20id", limit: int = MAX_POINTS) -> DataFrame:
    """points with final_grouping: the 100 km id if it has fewer than limit points, else the strip's, else the tile's."""
    big, strip = F.substring(F.col(tile), 1, 5), F.substring(F.col(tile), 1, 6)
    counted = with_count(with_count(points, big, "_b"), strip, "_s")
    group = F.when(F.col("_b") < limit, big).when(F.col("_s") < limit, strip).otherwise(F.col(tile))
    return counted.withColumn("final_grouping", group).drop("_b", "_s")


def error_reason(log: Column) -> Column:
    """Reason of a failure from its log, by the first rule that fits; null if none."""
    # The messages that tell the reasons apart, in this order.
    rules = (
        (r"Failed to allocate memory for image|OOM|exit code: 50", "OOM"), (r"NoDataAvailable", "NoDataAvailable"), (r"Orfeo toolbox.", "orfeo_error"),
        (r"No tiff for band VH", "no_VH_band"), (r"sar_backscatter: No tiffs found in", "no_tiff_in_S1"),
    )
    out = F.when(log.rlike(rules[0][0]), rules[0][1])
    for pattern, name in rules[1:]:
        out = out.when(log.rlike(pattern), name)
    return out


def next_status(previous: Column, reported: Column, attempt: Column, reason: Column, downloaded: Column, late: Column) -> Column:
    """Status of a job after a report.

    A finished job is downloaded first and stays so until downloaded; a late download runs again while attempts and two
    more are left. A new failure takes its known reason as status, else starts again while attempts are left. So does a
    cancelled job.
    """
    again = attempt <= MAX_ATTEMPTS
    loading = ((reported == "finished") & (previous != "downloading")) | ((previous == "downloading") & ~downloaded)
    stuck = loading & (previous == "downloading") & late
    failed = (reported == "error") & (previous != "error") & ~loading
    out = F.when(stuck & (attempt <= MAX_ATTEMPTS + 2), "running").when(stuck, "error_downloading").when(loading, "downloading")
    out = out.when(failed & reason.isNotNull(), reason).when(failed & again, "not_started").when(failed, "error_openeo")
    return out.when((reported == "canceled") & again, "not_started").otherwise(reported)


def next_attempt(previous: Column, state: Column, attempt: Column) -> Column:
    """Attempts after a report: one more where the job starts or downloads again (state: its next_status)."""
    again = (state == "not_started") | ((previous == "downloading") & (state == "running"))
    return F.when(F.coalesce(again, F.lit(False)), attempt + 1).otherwise(attempt)


def clean_reports(reports: DataFrame) -> DataFrame:
    """(id, t in microseconds, status, reason, downloaded) of the reports with an id, a time and a status; downloaded is false where null."""
    known = reports.where("id IS NOT NULL AND t IS NOT NULL AND status IS NOT NULL")
    return known.select("id", F.unix_micros("t").alias("t"), "status", F.col("reason").cast("string").alias("reason"), F.coalesce("downloaded", F.lit(False)).alias("downloaded"))


def fold_reports(reports: DataFrame, limit_s: float) -> DataFrame:
    """(id, status, attempt, n_reports, t) of each job after all its reports (id, t, status, reason, downloaded), in the order of time.

    A job begins as created, at its first attempt. Each report moves it by next_status and next_attempt; a download is
    late when more than limit_s seconds for each attempt so far have passed since it began. A job whose status isn't in ACTIVE has ended: reports
    after that change nothing and don't count. Reports of equal time go by status, reason and downloaded. The reports of
    one job, which are as many as it was asked for, are folded in one row.
    """
    rows = clean_reports(reports).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("t", "status", F.coalesce("reason", F.lit("")).alias("reason"), "downloaded"))).alias("rs"))
    none = F.lit(None).cast("long")
    start = F.struct(F.lit("created").alias("status"), F.lit(1).alias("attempt"), none.alias("since"), F.lit(0).cast("long").alias("n_reports"), none.alias("t"))

    def step(job: Column, r: Column) -> Column:
        late = F.coalesce(r["t"] - job["since"] > job["attempt"] * F.lit(int(limit_s * 1_000_000)), F.lit(False))
        state = next_status(job["status"], r["status"], job["attempt"], F.nullif(r["reason"], F.lit("")), r["downloaded"], late)
        since = F.when(state == "downloading", F.when(job["status"] == "downloading", job["since"]).otherwise(r["t"]))
        moved = F.struct(state.alias("status"), next_attempt(job["status"], state, job["attempt"]).alias("attempt"), since.alias("since"), (job["n_reports"] + 1).alias("n_reports"), r["t"].alias("t"))
        return F.when(job["status"].isin(*ACTIVE), moved).otherwise(job)

    done = rows.select("id", F.aggregate("rs", start, step).alias("job"))
    return done.select("id", "job.status", "job.attempt", "job.n_reports", F.timestamp_micros("job.t").alias("t"))


def update_by_key(table: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """A new snapshot of table with the columns of updates (one row for each key) where they aren't null."""
    changed = [c for c in updates.columns if c != key]
    new = updates.select(key, *[F.col(c).alias(f"_{c}") for c in changed])
    return table.join(new, key, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in changed else F.col(c) for c in table.columns])


def cost_summary(jobs: DataFrame, by: str) -> DataFrame:
    """(by, n_jobs, credits, euro) of each group."""
    return jobs.groupBy(by).agg(F.count("*").alias("n_jobs"), F.sum("cost").alias("credits"), (F.sum("cost") * PRICE).alias("euro"))


def enough_s1(items: DataFrame, keys: list[str], wanted: str | None, days: int) -> DataFrame:
    """(keys, n_wanted, n_all, orbit): the requested orbit if it has enough items, else 'BOTH' if all have, else null.

    Enough is four fifths of one item in twelve days.
    """
    need = days * 0.8 / 12
    hit = F.col("orbit_state") == wanted if wanted else F.lit(True)
    out = items.groupBy(*keys).agg(F.count(F.when(hit, 1)).alias("n_wanted"), F.count("*").alias("n_all"))
    return out.withColumn("orbit", F.when(F.col("n_wanted") >= need, F.lit(wanted or "BOTH")).when(F.col("n_all") >= need, "BOTH"))


def enough_s2(items: DataFrame, keys: list[str], days: int, every: int = 5) -> DataFrame:
    """(keys, n_dates, enough): distinct days against four fifths of one in ``every`` days."""
    out = items.groupBy(*keys).agg(F.countDistinct(F.to_date("t")).alias("n_dates"))
    return out.withColumn("enough", F.col("n_dates") >= days * 0.8 / every)


def drop_all_duplicates(df: DataFrame, key: str) -> DataFrame:
    """df without every row whose key occurs more than once."""
    once = df.groupBy(key).agg(F.count("*").alias("_n")).where("_n = 1").select(key)
    return df.join(once, key, "left_semi").select(*df.columns)


def tile_jobs(tiles: DataFrame, prefix: str, start: str, stop: str, model: str) -> DataFrame:
    """A job row for each tile."""
    name = F.concat_ws("_", F.lit(prefix), "name")
    bbox = F.to_json(F.struct("west", "south", "east", "north"))
    return tiles.select("name", F.col("name").alias("tileID"), F.lit(3035).alias("target_epsg"), bbox.alias("bbox"), name.alias("file_prefix"), F.lit(start).alias("start_date"), F.lit(stop).alias("end_date"), F.lit(model).alias("model_id"))


def point_jobs(points: DataFrame, group: str = "final_grouping") -> DataFrame:
    """(group, n_points, geojson): a FeatureCollection of each group's points, in the order of their ids.

    A group is a job of at most MAX_POINTS points, or one 20 km tile, whose points all stand in its one row.
    """
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"), F.struct("point_id").alias("properties"))
    rows = points.groupBy(group).agg(F.count("*").alias("n_points"), F.array_sort(F.collect_list(F.struct("point_id", feature.alias("f")))).alias("fs"))
    body = F.struct(F.lit("FeatureCollection").alias("type"), F.col("fs.f").alias("features"))
    return rows.select(group, "n_points", F.to_json(body).alias("geojson"))
