"""Queries of job tables, duplicates, classification, sources and streams."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from pixelloom.functions import text
from pixelloom.operators import classify, grids, jobs, joins
from pixelloom.plans.registry import query, rounded, rounds
from pixelloom.plans.views import view
from pixelloom.sources import files


def _keyed(spark, d):
    """Reference points with a 20 km id of few 100 km cells, so that jobs of every kind occur."""
    at = lambda letters, i: F.substring(F.lit(letters), (i + 1).cast("int"), F.lit(1))
    key = F.concat(
        F.lit("31n"), F.lit("A"), at("ABCDEFGHJKLMNPQRSTUV", F.floor(F.col("northing") / 100_000) % 4), (F.col("point_id") % 5).cast("string"), (F.col("point_id") % 3).cast("string")
    )
    return view(spark, d, "ref_points").withColumn("grid20id", key)


_KEY = "k AS (SELECT *, '31nA' || substr('ABCDEFGHJKLMNPQRSTUV', CAST(floor(northing / 100000) AS INT) % 4 + 1, 1) || CAST(point_id % 5 AS VARCHAR) || CAST(point_id % 3 AS VARCHAR) AS grid20id FROM ref_points)"
_SPLIT = f"{_KEY}, j AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY substr(grid20id, 1, 5)) < 256 THEN substr(grid20id, 1, 5) WHEN count(*) OVER (PARTITION BY substr(grid20id, 1, 6)) < 256 THEN substr(grid20id, 1, 6) ELSE grid20id END AS final_grouping FROM k)"


@query("job_splitter", f"WITH {_SPLIT} SELECT point_id, grid20id, final_grouping FROM j", "ref_points")
def job_splitter(spark, d):
    return jobs.split_jobs(_keyed(spark, d)).select("point_id", "grid20id", "final_grouping")


@query("group_count_transform", "SELECT point_id, label, count(*) OVER (PARTITION BY label) AS n FROM ref_points", "ref_points")
def group_count_transform(spark, d):
    return jobs.with_count(view(spark, d, "ref_points").select("point_id", "label"), F.col("label"), "n")


@query("split_by_key", f"WITH {_SPLIT} SELECT final_grouping, count(*) AS n, min(point_id) AS first_point FROM j GROUP BY final_grouping", "ref_points")
def split_by_key(spark, d):
    dealt = jobs.split_jobs(_keyed(spark, d)).repartition("final_grouping")
    return dealt.groupBy("final_grouping").agg(F.count("*").alias("n"), F.min("point_id").alias("first_point"))


@query("count_points_per_job", f"WITH {_SPLIT} SELECT final_grouping, count(*) AS n_points FROM j GROUP BY final_grouping", "ref_points")
def count_points_per_job(spark, d):
    made = jobs.point_jobs(jobs.split_jobs(_keyed(spark, d)))
    return made.select("final_grouping", F.size(F.from_json("geojson", files.GEOJSON)["features"]).cast("long").alias("n_points"))


@query("job_table_points", f"WITH {_SPLIT} SELECT final_grouping, count(*) AS n_points, string_agg(CAST(point_id AS VARCHAR), ',' ORDER BY point_id) AS ids, TRUE AS valid FROM j GROUP BY final_grouping", "ref_points")
def job_table_points(spark, d):
    made = jobs.point_jobs(jobs.split_jobs(_keyed(spark, d)))
    ids = F.array_join(F.transform(F.from_json("geojson", files.GEOJSON)["features"], lambda f: f["properties"]["point_id"]), ",")
    return made.select("final_grouping", "n_points", ids.alias("ids"), files.is_valid_geojson(F.col("geojson")).alias("valid"))


@query("job_table_tiles", "SELECT name, name AS tileID, 3035 AS target_epsg, 'lc_' || name AS file_prefix, '2021-01-01' AS start_date, '2022-01-01' AS end_date, 'm1' AS model_id FROM laea_tiles", "laea_tiles")
def job_table_tiles(spark, d):
    tiles = grids.laea_100k(spark).join(view(spark, d, "laea_tiles"), "name", "left_semi")
    return jobs.tile_jobs(tiles, "lc", "2021-01-01", "2022-01-01", "m1").drop("bbox")


@query("join_job_geometry", "SELECT t.name, a.aoi_id FROM laea_tiles t JOIN (SELECT aoi_id, 'E' || lpad(CAST(CAST(floor(west / 100000) AS INT) AS VARCHAR), 2, '0') || 'N' || lpad(CAST(CAST(floor(south / 100000) AS INT) AS VARCHAR), 2, '0') AS name FROM aoi_boxes) a USING (name)", "laea_tiles aoi_boxes")
def join_job_geometry(spark, d):
    part = lambda c: F.lpad(F.floor(F.col(c) / 100_000).cast("string"), 2, "0")
    geo = view(spark, d, "aoi_boxes").select("aoi_id", F.concat(F.lit("E"), part("west"), F.lit("N"), part("south")).alias("name"))
    return view(spark, d, "laea_tiles").join(geo, "name").select("name", "aoi_id")


_REASON = "CASE WHEN regexp_matches(log_text, 'Failed to allocate memory for image|OOM|exit code: 50') THEN 'OOM' WHEN regexp_matches(log_text, 'NoDataAvailable') THEN 'NoDataAvailable' WHEN regexp_matches(log_text, 'Orfeo toolbox.') THEN 'orfeo_error' WHEN regexp_matches(log_text, 'No tiff for band VH') THEN 'no_VH_band' WHEN regexp_matches(log_text, 'sar_backscatter: No tiffs found in') THEN 'no_tiff_in_S1' END"


@query("classify_error_log", f"SELECT id, {_REASON} AS reason FROM job_tracker", "job_tracker")
def classify_error_log(spark, d):
    return view(spark, d, "job_tracker").select("id", jobs.error_reason(F.col("log_text")).alias("reason"))


_NEXT = f"""SELECT id, CASE WHEN loading AND previous_status = 'downloading' AND late AND attempt <= 5 THEN 'running' WHEN loading AND previous_status = 'downloading' AND late THEN 'error_downloading' WHEN loading THEN 'downloading'
 WHEN status = 'error' AND previous_status <> 'error' AND reason IS NOT NULL THEN reason WHEN status = 'error' AND previous_status <> 'error' AND attempt <= 3 THEN 'not_started' WHEN status = 'error' AND previous_status <> 'error' THEN 'error_openeo' ELSE status END AS next
 FROM (SELECT *, {_REASON} AS reason, cost > 400 AS late, (status = 'finished' AND previous_status <> 'downloading') OR (previous_status = 'downloading' AND NOT (cost < 100)) AS loading FROM job_tracker)"""


@query("next_job_status", _NEXT, "job_tracker")
def next_job_status(spark, d):
    j = view(spark, d, "job_tracker")
    state = jobs.next_status(F.col("previous_status"), F.col("status"), F.col("attempt"), jobs.error_reason(F.col("log_text")), F.col("cost") < 100, F.col("cost") > 400)
    return j.select("id", state.alias("next"))


@query("next_job_attempt", f"SELECT id, CASE WHEN next = 'not_started' OR (previous_status = 'downloading' AND next = 'running') THEN attempt + 1 ELSE attempt END AS attempt FROM ({_NEXT}) JOIN job_tracker USING (id)", "job_tracker")
def next_job_attempt(spark, d):
    j = view(spark, d, "job_tracker")
    state = jobs.next_status(F.col("previous_status"), F.col("status"), F.col("attempt"), jobs.error_reason(F.col("log_text")), F.col("cost") < 100, F.col("cost") > 400)
    return j.select("id", jobs.next_attempt(F.col("previous_status"), state, F.col("attempt")).alias("attempt"))


@query("status_histogram", "SELECT status, count(*) AS n, bool_and(attempt < 6) AS all_under FROM job_tracker GROUP BY status", "job_tracker")
def status_histogram(spark, d):
    return view(spark, d, "job_tracker").groupBy("status").agg(F.count("*").alias("n"), F.bool_and(F.col("attempt") < 6).alias("all_under"))


@query("cost_summary", rounds("SELECT status, count(*) AS n_jobs, sum(cost) AS credits, sum(cost) * 0.01 AS euro FROM job_tracker GROUP BY status", "credits euro", 3), "job_tracker")
def cost_summary(spark, d):
    return rounded(jobs.cost_summary(view(spark, d, "job_tracker"), "status"), 3)


@query("label_lookup", "SELECT id, CASE status WHEN 'finished' THEN 'green' WHEN 'running' THEN 'blue' ELSE 'grey' END AS colour FROM job_tracker", "job_tracker")
def label_lookup(spark, d):
    return joins.lookup(view(spark, d, "job_tracker"), "status", {"finished": "green", "running": "blue"}, "grey", "colour").select("id", "colour")


@query("update_status_by_key", "SELECT j.id, coalesce(u.status, j.status) AS status, coalesce(u.attempt, j.attempt) AS attempt FROM job_tracker j LEFT JOIN (SELECT id, CASE WHEN id % 2 = 0 THEN 'done' END AS status, attempt + 1 AS attempt FROM job_tracker WHERE id % 7 = 0) u USING (id)", "job_tracker")
def update_status_by_key(spark, d):
    j = view(spark, d, "job_tracker").select("id", "status", "attempt")
    new = j.where("id % 7 = 0").select("id", F.when(F.col("id") % 2 == 0, "done").alias("status"), (F.col("attempt") + 1).alias("attempt"))
    return jobs.update_by_key(j, new, "id")


@query("count_distinct_dates", "SELECT band, count(DISTINCT CAST(t AS DATE)) AS n FROM obs_long GROUP BY band", "obs_long")
def count_distinct_dates(spark, d):
    return view(spark, d, "obs_long").groupBy("band").agg(F.countDistinct(F.to_date("t")).alias("n"))


@query("count_items_capped", "SELECT x, y, least(count(*), 100) AS n FROM obs_long GROUP BY x, y", "obs_long")
def count_items_capped(spark, d):
    return view(spark, d, "obs_long").groupBy("x", "y").agg(F.least(F.count("*"), F.lit(jobs.PAGE)).alias("n"))


@query("catalogue_check_s1", "SELECT x, y, count(*) FILTER (orbit_state = 'ASCENDING') AS n_wanted, count(*) AS n_all, CASE WHEN count(*) FILTER (orbit_state = 'ASCENDING') >= 300 * 0.8 / 12 THEN 'ASCENDING' WHEN count(*) >= 300 * 0.8 / 12 THEN 'BOTH' END AS orbit FROM obs_long GROUP BY x, y", "obs_long")
def catalogue_check_s1(spark, d):
    return jobs.enough_s1(view(spark, d, "obs_long"), ["x", "y"], "ASCENDING", 300)


@query("catalogue_check_s2", "SELECT x, y, count(DISTINCT CAST(t AS DATE)) AS n_dates, count(DISTINCT CAST(t AS DATE)) >= 140 * 0.8 / 5 AS enough FROM obs_long GROUP BY x, y", "obs_long")
def catalogue_check_s2(spark, d):
    return jobs.enough_s2(view(spark, d, "obs_long"), ["x", "y"], 140)


_DUP = "p AS (SELECT point_id, CAST(floor(lon) AS INT) AS k FROM ref_points)"


def _dup(spark, d):
    return view(spark, d, "ref_points").select("point_id", F.floor("lon").cast("int").alias("k"))


@query("drop_all_duplicates", f"WITH {_DUP} SELECT point_id, k FROM p WHERE k IN (SELECT k FROM p GROUP BY k HAVING count(*) = 1)", "ref_points")
def drop_all_duplicates(spark, d):
    return jobs.drop_all_duplicates(_dup(spark, d), "k")


@query("report_duplicates", f"WITH {_DUP} SELECT k, count(*) AS n FROM p GROUP BY k HAVING count(*) > 1", "ref_points")
def report_duplicates(spark, d):
    return _dup(spark, d).groupBy("k").agg(F.count("*").alias("n")).where("n > 1")


@query("distinct_ids", "SELECT DISTINCT tile_id FROM job_tracker", "job_tracker")
def distinct_ids(spark, d):
    return view(spark, d, "job_tracker").select("tile_id").distinct()


@query("concat_frames", "SELECT name, NULL AS aoi_name FROM laea_tiles UNION ALL SELECT NULL, aoi_name FROM aoi_boxes", "laea_tiles aoi_boxes")
def concat_frames(spark, d):
    return view(spark, d, "laea_tiles").unionByName(view(spark, d, "aoi_boxes").select("aoi_name"), allowMissingColumns=True)


@query("concat_bands", "SELECT vec_id, 'p1' AS band, p1 AS v FROM class_probs UNION ALL SELECT vec_id, 'p2', p2 FROM class_probs UNION ALL SELECT vec_id, 'p3', p3 FROM class_probs", "class_probs")
def concat_bands(spark, d):
    return files.split_bands(view(spark, d, "class_probs"), ["p1", "p2", "p3"], ["vec_id"]).withColumnRenamed("value", "v")


@query("join_features_to_points", rounds("SELECT point_id, label, f.v FROM ref_points LEFT JOIN (SELECT x * 50 + y AS point_id, avg(B08) AS v FROM refl_wide GROUP BY x, y) f USING (point_id)", "v", 3), "ref_points refl_wide")
def join_features_to_points(spark, d):
    f = view(spark, d, "refl_wide").groupBy("x", "y").agg(F.avg("B08").alias("v")).select((F.col("x") * 50 + F.col("y")).cast("long").alias("point_id"), "v")
    return rounded(view(spark, d, "ref_points").select("point_id", "label").join(f, "point_id", "left"), 3)


# Classification.
@query("argmax_class", "SELECT vec_id, CASE WHEN p1 >= p2 AND p1 >= p3 THEN 10100 WHEN p2 >= p3 THEN 10200 ELSE 20100 END AS code FROM class_probs", "class_probs")
def argmax_class(spark, d):
    return view(spark, d, "class_probs").select("vec_id", classify.argmax_wide(["p1", "p2", "p3"], [10100, 10200, 20100]).alias("code"))


@query("argmax_per_model", "SELECT vec_id, CASE WHEN p1 >= p2 AND p1 >= p3 THEN 10100 WHEN p2 >= p3 THEN 10200 ELSE 20100 END AS raster_code FROM class_probs", "class_probs")
def argmax_per_model(spark, d):
    long = files.split_bands(view(spark, d, "class_probs"), ["p1", "p2", "p3"], ["vec_id"])
    nr = F.substring("band", 2, 1).cast("int")
    code = F.when(nr == 1, 10100).when(nr == 2, 10200).otherwise(20100)
    return classify.argmax_long(long.select("vec_id", nr.alias("band_nr"), code.alias("raster_code"), F.col("value").alias("prob")), ["vec_id"])


_W = "w AS (SELECT vec_id, CASE WHEN p1 >= p2 THEN 10000 ELSE 20000 END AS l1, CASE WHEN p2 >= p3 THEN 10100 ELSE 10200 END AS l2, CASE WHEN p1 >= p3 THEN 10101 WHEN p3 > 0.3 THEN 0 ELSE 10102 END AS l3 FROM class_probs)"


@query("hierarchical_merge", f"WITH {_W}, a AS (SELECT *, CASE WHEN l1 = 10000 THEN l2 ELSE l1 END AS c FROM w) SELECT vec_id, CASE WHEN c = 10100 AND l3 <> 0 THEN l3 ELSE c END AS code FROM a", "class_probs")
def hierarchical_merge(spark, d):
    p1, p2, p3 = F.col("p1"), F.col("p2"), F.col("p3")
    w = view(spark, d, "class_probs").select("vec_id", F.when(p1 >= p2, 10000).otherwise(20000).alias("l1"), F.when(p2 >= p3, 10100).otherwise(10200).alias("l2"), F.when(p1 >= p3, 10101).when(p3 > 0.3, 0).otherwise(10102).alias("l3"))
    classify.check_one_parent(w, "l2", 2)
    return classify.hierarchical(w, "l1", [("l2", 10000, 2), ("l3", 10100, 3)]).select("vec_id", "code")


@query("parse_class_band", "SELECT vec_id, CAST(vec_id % 3 + 1 AS INT) AS level, 'm' || (vec_id % 4) AS model, 'forest' AS habitat, CAST(vec_id * 100 AS INT) AS raster_code FROM class_probs WHERE vec_id % 5 <> 0", "class_probs")
def parse_class_band(spark, d):
    v = view(spark, d, "class_probs")
    i = F.col("vec_id")
    good = F.concat(F.lit("Level"), (i % 3 + 1).cast("string"), F.lit("_class-m"), (i % 4).cast("string"), F.lit("_habitat-forest-"), (i * 100).cast("string"))
    v = v.select("vec_id", F.when(i % 5 != 0, good).otherwise("NDVI_mean").alias("band"))
    return v.where(F.col("band").rlike(classify.BAND)).select("vec_id", *classify.parse_band(F.col("band")))


@query("parent_class_code", "SELECT vec_id, CAST(floor((vec_id * 37 + 10000) / 10000) * 10000 AS INT) AS l1, CAST(floor((vec_id * 37 + 10000) / 100) * 100 AS INT) AS l2 FROM class_probs", "class_probs")
def parent_class_code(spark, d):
    code = F.col("vec_id") * 37 + 10000
    return view(spark, d, "class_probs").select("vec_id", classify.parent_code(code, 2).alias("l1"), classify.parent_code(code, 3).alias("l2"))


@query("probability_postprocess", "SELECT vec_id, 'p' || n AS cls, CAST(floor(p * 100) AS INT) AS pct FROM (SELECT vec_id, 1 AS n, p1 AS p FROM class_probs UNION ALL SELECT vec_id, 2, p2 FROM class_probs)", "class_probs")
def probability_postprocess(spark, d):
    v = view(spark, d, "class_probs").withColumn("0", F.lit(0.0))
    long = files.split_bands(v, ["0", "p1", "p2"], ["vec_id"]).where("band <> '0'")
    return long.select("vec_id", F.col("band").alias("cls"), classify.to_percent(F.col("value")).alias("pct"))


def _registry(spark, d):
    return view(spark, d, "job_tracker").select(F.concat(F.lit("model-"), F.col("id").cast("string")).alias("model_id"), F.format_string('"B%02d, B%02d"', (F.col("tile_id") % 12).cast("int"), (F.col("attempt") + 2).cast("int")).alias("outputs"), "id")


@query("model_lookup", "SELECT 'model-' || id AS model_id, id FROM job_tracker WHERE id = (SELECT min(id) FROM job_tracker)", "job_tracker")
def model_lookup(spark, d):
    reg = _registry(spark, d)
    first = reg.agg(F.min("id").alias("i")).first().i
    return classify.model_row(reg, f"model-{first}").select("model_id", "id")


@query("parse_onnx_feature_lists", "SELECT id, printf('B%02d', tile_id % 12) AS a, printf('B%02d', attempt + 2) AS b FROM job_tracker", "job_tracker")
def parse_onnx_feature_lists(spark, d):
    names = text.feature_list(F.col("outputs"))
    return _registry(spark, d).select("id", names[0].alias("a"), names[1].alias("b"))


@query("model_output_names", "SELECT id * 10 + 1 AS pos, printf('B%02d', tile_id % 12) AS name FROM job_tracker UNION ALL SELECT id * 10 + 2, printf('B%02d', attempt + 2) FROM job_tracker", "job_tracker")
def model_output_names(spark, d):
    each = _registry(spark, d).select("id", F.posexplode(text.feature_list(F.col("outputs"))).alias("i", "name"))
    return each.select((F.col("id") * 10 + F.col("i") + 1).alias("pos"), "name")


@query("parse_list_column", "SELECT point_id, CASE WHEN point_id % 3 < 2 THEN 'l' || chr(39) || label ELSE label END AS first_item, CAST(2 AS BIGINT) AS n FROM ref_points", "ref_points")
def parse_list_column(spark, d):
    p = view(spark, d, "ref_points")
    py = F.concat(F.lit("['l'"), F.col("label"), F.lit("', \"b\"]"))  # an apostrophe in the item
    js = F.concat(F.lit('["l\'') , F.col("label"), F.lit('", "b"]'))
    raw = F.when(F.col("point_id") % 3 == 0, py).when(F.col("point_id") % 3 == 1, js).otherwise(F.concat(F.col("label"), F.lit(", b")))
    items = text.parse_list(raw)
    return p.select("point_id", items[0].alias("first_item"), F.size(items).cast("long").alias("n"))


@query("parse_bbox_dict", "SELECT aoi_id, west, north, 3035 AS crs FROM aoi_boxes", "aoi_boxes")
def parse_bbox_dict(spark, d):
    raw = F.concat(F.lit("{'west': "), F.col("west").cast("string"), F.lit(", 'south': 1.0, 'east': 2.0, 'north': "), F.col("north").cast("string"), F.lit(", 'crs': 4326}"))
    box = text.parse_bbox(raw, 3035)
    return view(spark, d, "aoi_boxes").select("aoi_id", box["west"].alias("west"), box["north"].alias("north"), box["crs"].alias("crs"))


@query("is_valid_geojson", "SELECT point_id, point_id % 3 <> 0 AS valid FROM ref_points", "ref_points")
def is_valid_geojson(spark, d):
    p = view(spark, d, "ref_points")
    point = F.format_string('{"type": "Point", "coordinates": [%f, %f]}', "lon", "lat")
    kind = F.col("point_id") % 3
    raw = F.when(kind == 0, F.lit('{"type": "Circle"}')).when(kind == 1, point).otherwise(F.concat(F.lit('{"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": '), point, F.lit("}]}")))
    return p.select("point_id", files.is_valid_geojson(raw).alias("valid"))


@query("unique_id", "SELECT id, substr(strftime(start_time, '%Y%m%d') || '-' || regexp_replace(sha256(CAST(id AS VARCHAR)), '(.{6})', '\\1-', 'g'), 1, 40) AS uid FROM job_tracker", "job_tracker")
def unique_id(spark, d):
    return view(spark, d, "job_tracker").select("id", text.unique_id(F.col("start_time"), F.col("id"), 40).alias("uid"))


_LOADINGS = [[0.5, -0.2], [0.3, 0.7], [-0.4, 0.1]]


@query("pca_project", rounds("SELECT vec_id, 0.5 * p1 + 0.3 * p2 - 0.4 * p3 AS COMP1, -0.2 * p1 + 0.7 * p2 + 0.1 * p3 AS COMP2 FROM class_probs", "COMP1 COMP2", 6), "class_probs")
def pca_project(spark, d):
    return rounded(classify.project(view(spark, d, "class_probs"), ["p1", "p2", "p3"], _LOADINGS, ["vec_id"]), 6)


@query("pca_loadings")
def pca_loadings(spark, d):
    return classify.loading_table(view(spark, d, "class_probs"), ["p1", "p2", "p3"], 2)


def _long_loadings(spark, d):
    """A loading for each tile and attempt, from the costs of the tracker."""
    j = view(spark, d, "job_tracker")
    return j.groupBy(F.concat(F.lit("B"), F.col("tile_id").cast("string")).alias("band"), F.col("attempt").alias("comp")).agg((F.avg("cost") / 1000 - 0.15).alias("loading"))


_LOAD = "l AS (SELECT 'B' || tile_id AS band, attempt AS comp, avg(cost) / 1000 - 0.15 AS loading FROM job_tracker GROUP BY ALL), s AS (SELECT band, sum(abs(loading)) / (SELECT sum(abs(loading)) FROM l) AS score FROM l GROUP BY band)"


@query("pca_contribution_scores", f"WITH {_LOAD} {rounds('SELECT * FROM s', 'score', 7)}", "job_tracker")
def pca_contribution_scores(spark, d):
    return rounded(classify.contribution(_long_loadings(spark, d)), 7)


@query("topk_bands", f"WITH {_LOAD} SELECT band FROM s ORDER BY score DESC, band LIMIT 7", "job_tracker")
def topk_bands(spark, d):
    return classify.top_bands(classify.contribution(_long_loadings(spark, d)), k=7).select("band")


@query("max_loading_filter", f"WITH {_LOAD} {rounds('SELECT band, max(abs(loading)) AS top FROM l GROUP BY band HAVING max(abs(loading)) >= 0.02', 'top', 7)}", "job_tracker")
def max_loading_filter(spark, d):
    by = _long_loadings(spark, d).groupBy("band").agg(F.max(F.abs("loading")).alias("top")).where("top >= 0.02")
    return rounded(by, 7)


# The first component by squaring the covariance matrix again and again, each time divided by its trace: what is left are
# products of its loadings.
_FIRST = """RECURSIVE q AS (SELECT p1, p2 * 2 AS p2, p3 * 3 AS p3 FROM class_probs),
m AS (SELECT 0 AS i, var_samp(p1) AS a, covar_samp(p1, p2) AS b, covar_samp(p1, p3) AS c, var_samp(p2) AS d, covar_samp(p2, p3) AS e, var_samp(p3) AS f FROM q
 UNION ALL SELECT i + 1, (a*a + b*b + c*c) / t, (a*b + b*d + c*e) / t, (a*c + b*e + c*f) / t, (b*b + d*d + e*e) / t, (b*c + d*e + e*f) / t, (c*c + e*e + f*f) / t
 FROM (SELECT *, a*a + 2*b*b + 2*c*c + d*d + 2*e*e + f*f AS t FROM m) WHERE i < 30),
v AS (SELECT unnest(['p1', 'p2', 'p3']) AS band, unnest([sqrt(a), sqrt(d), sqrt(f)]) AS size FROM m WHERE i = 30)"""


def _scaled_probs(spark, d):
    return view(spark, d, "class_probs").select("vec_id", "p1", (F.col("p2") * 2).alias("p2"), (F.col("p3") * 3).alias("p3"))


@query("first_component", f"WITH {_FIRST} {rounds('SELECT band, size FROM v', 'size', 5)}".replace("WITH RECURSIVE q", "WITH RECURSIVE class_probs AS (SELECT vec_id, abs(CAST(embedding[1] AS DOUBLE)) AS p1, abs(CAST(embedding[2] AS DOUBLE)) AS p2, abs(CAST(embedding[3] AS DOUBLE)) AS p3 FROM embeddings), q"))
def first_component(spark, d):
    loads = classify.loading_table(_scaled_probs(spark, d), ["p1", "p2", "p3"], 1)
    return rounded(loads.select("band", F.abs("loading").alias("size")), 5)


@query("select_significant_bands", f"WITH {_FIRST}, k AS (SELECT band FROM v ORDER BY size DESC, band LIMIT 2) SELECT vec_id, band, CASE band WHEN 'p1' THEN p1 WHEN 'p2' THEN p2 * 2 ELSE p3 * 3 END AS value FROM class_probs, k".replace("WITH RECURSIVE q", "WITH RECURSIVE class_probs AS (SELECT vec_id, abs(CAST(embedding[1] AS DOUBLE)) AS p1, abs(CAST(embedding[2] AS DOUBLE)) AS p2, abs(CAST(embedding[3] AS DOUBLE)) AS p3 FROM embeddings), q"))
def select_significant_bands(spark, d):
    """Fit, score by contribution to the first component, select two of the three bands."""
    v = _scaled_probs(spark, d)
    scores = classify.contribution(classify.loading_table(v, ["p1", "p2", "p3"], 1))
    kept = classify.select_bands(v, scores, ["vec_id"], k=2)
    return kept.unpivot(["vec_id"], [c for c in kept.columns if c != "vec_id"], "band", "value")


@query("cumulative_variance", rounds("SELECT tile_id, sum(v) OVER (ORDER BY tile_id) AS share FROM (SELECT tile_id, sum(cost) / (SELECT sum(cost) FROM job_tracker) AS v FROM job_tracker GROUP BY tile_id)", "share", 6), "job_tracker")
def cumulative_variance(spark, d):
    from pyspark.sql.window import Window

    j = view(spark, d, "job_tracker").groupBy("tile_id").agg(F.sum("cost").alias("v"))  # 50 tiles
    total = F.sum("v").over(Window.partitionBy())
    run = F.sum("v").over(Window.orderBy("tile_id").rowsBetween(Window.unboundedPreceding, 0))
    return rounded(j.select("tile_id", (run / total).alias("share")), 6)


@query("model_ensemble_inference", "SELECT vec_id, CAST(floor(q1 * 100) AS INT) AS a1, CAST(floor(q2 * 100) AS INT) AS a2, CAST(floor((0.5::DOUBLE * q3 + 0.25::DOUBLE * q1) * 100) AS INT) AS b1 FROM (SELECT vec_id, CAST(CAST(p1 AS FLOAT) AS DOUBLE) AS q1, CAST(CAST(p2 AS FLOAT) AS DOUBLE) AS q2, CAST(CAST(p3 AS FLOAT) AS DOUBLE) AS q3 FROM class_probs)", "class_probs")
def model_ensemble_inference(spark, d):
    """Two models with inputs and classes of their own, in one pass."""
    models = [{"id": "a", "inputs": ["p1", "p2"], "outputs": ["a1", "a2"]}, {"id": "b", "inputs": ["p3", "p1"], "outputs": ["b1"]}]
    return classify.score_models(view(spark, d, "class_probs"), models, _load_linear, ["vec_id"])


def _load_linear(model: str):
    """Weights of a model by its id; a is the identity."""
    import numpy as np

    weights = {"a": [[1.0, 0.0], [0.0, 1.0]], "b": [[0.5], [0.25]]}[model]
    return lambda x: x.astype(np.float64) @ np.array(weights)


# Sources and sinks: written from the tables to a temporary folder and read back.
def _folder() -> str:
    return tempfile.mkdtemp(prefix="pixelloom-")


def _shared(spark) -> str:
    """A folder that all executors see: under spark.checkpoint.dir where that is set."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{base.rstrip('/')}/io-{uuid.uuid4().hex}" if base else _folder()


@query("read_result_parquets", "SELECT vec_id, p1, NULL AS p2 FROM class_probs WHERE vec_id % 2 = 0 UNION ALL SELECT vec_id, p1, p2 FROM class_probs WHERE vec_id % 2 = 1", "class_probs")
def read_result_parquets(spark, d):
    v, root = view(spark, d, "class_probs"), _shared(spark)
    v.where("vec_id % 2 = 0").select("vec_id", "p1").write.parquet(f"{root}/a")
    v.where("vec_id % 2 = 1").select("vec_id", "p1", "p2").write.parquet(f"{root}/b")
    return files.read_results(spark, [f"{root}/a", f"{root}/b"])


@query("write_cube", "SELECT x, y, scl FROM scl_raster", "scl_raster")
def write_cube(spark, d):
    root = _shared(spark) + "/cube"
    files.write_cube(view(spark, d, "scl_raster"), root, ["scl"])
    return spark.read.parquet(root).select("x", "y", "scl")


@query("read_points_csv", "SELECT point_id, lon, lat, label FROM ref_points", "ref_points")
def read_points_csv(spark, d):
    root = _shared(spark) + "/points"
    files.write_cube(view(spark, d, "ref_points").select("point_id", "lon", "lat", "label"), root, fmt="csv")
    return files.read_points_csv(spark, root, "point_id long, lon double, lat double, label string")


@query("persist_job_table", "SELECT id, status FROM job_tracker", "job_tracker")
def persist_job_table(spark, d):
    root = _shared(spark) + "/jobs"
    files.persist_jobs(view(spark, d, "job_tracker").select("id", "status"), root)
    return files.persist_jobs(view(spark, d, "job_tracker").select("id", "status").limit(0), root)


@query("read_geojson", f"WITH {_SPLIT} SELECT point_id, 'Point' AS geometry FROM j", "ref_points")
def read_geojson(spark, d):
    root = _shared(spark) + "/geojson"
    jobs.point_jobs(jobs.split_jobs(_keyed(spark, d))).repartition("final_grouping").select("geojson").write.option("maxRecordsPerFile", 1).text(root)
    got = files.read_geojson(spark, root)
    return got.select(F.element_at("properties", "point_id").cast("long").alias("point_id"), "geometry")


@query("list_files", "SELECT 'scl=' || scl AS folder, count(*) AS n_rows, TRUE AS has_bytes FROM scl_raster GROUP BY scl", "scl_raster")
def list_files(spark, d):
    """A folder for each class is written; the listing must name each, and the footers their rows."""
    root = _shared(spark) + "/files"
    files.write_cube(view(spark, d, "scl_raster"), root, ["scl"])
    folder = F.regexp_extract("path", r"(scl=\d+)/part-", 1)
    sizes = files.list_files(spark, root, ".parquet").groupBy(folder.alias("folder")).agg((F.min("length") > 0).alias("has_bytes"))
    return sizes.join(files.parquet_footers(spark, root).groupBy(folder.alias("folder")).agg(F.sum("n_rows").alias("n_rows")), "folder").select("folder", "n_rows", "has_bytes")


@query("parquet_footers", "SELECT c AS column_name, (SELECT count(*) FROM class_probs) AS n_rows, u AS unit FROM (VALUES ('vec_id', NULL), ('p1', 'percent'), ('p2', NULL)) v(c, u)", "class_probs")
def parquet_footers(spark, d):
    """The schema and a column's unit from the key-value metadata in the footers of written files."""
    root = _shared(spark) + "/footers"
    v = view(spark, d, "class_probs").select("vec_id", F.col("p1").alias("p1", metadata={"unit": "percent"}), "p2")
    v.repartition(3).write.parquet(root)
    fields = F.from_json(F.col("metadata")["org.apache.spark.sql.parquet.row.metadata"], "fields array<struct<name:string,metadata:struct<unit:string>>>")["fields"]
    rows = files.parquet_footers(spark, root).select("n_rows", F.explode(fields).alias("f"))
    return rows.groupBy(F.col("f.name").alias("column_name"), F.col("f.metadata.unit").alias("unit")).agg(F.sum("n_rows").alias("n_rows"))


@query("verify_checksums", "SELECT point_id AS path, point_id % 4 <> 3 AS ok, md5(repeat(label, 5)) AS whole, CASE WHEN point_id % 2 = 1 THEN md5(unhex(md5(substr(repeat(label, 5), 1, 16))) || unhex(md5(substr(repeat(label, 5), 17, 16))) || unhex(md5(substr(repeat(label, 5), 33)))) || '-3' END AS parted FROM ref_points WHERE length(label) * 5 BETWEEN 33 AND 48", "ref_points")
def verify_checksums(spark, d):
    """A third of the odd ids have one byte changed after their tag was made."""
    p = view(spark, d, "ref_points").where("length(label) * 5 BETWEEN 33 AND 48").select(F.col("point_id").alias("path"), F.repeat("label", 5).alias("s"))
    content = F.when(F.col("path") % 4 == 3, F.concat(F.lit("#"), F.expr("substring(s, 2)"))).otherwise(F.col("s"))
    tag = F.when(F.col("path") % 2 == 0, F.md5(F.encode("s", "utf-8"))).otherwise(files.multipart_etag(F.encode("s", "utf-8"), 16))
    made = p.select("path", F.encode(content, "utf-8").alias("content"), F.md5(F.encode("s", "utf-8")).alias("whole"), tag.alias("etag"))
    checked = files.verify_checksums(made.select("path", "content"), made.select("path", "etag"), [8, 16]).select("path", "ok")
    return checked.join(made, "path").select("path", "ok", "whole", F.when(F.col("path") % 2 == 1, F.col("etag")).alias("parted"))


@query("load_stac", "SELECT obs_id, band, value FROM obs_long WHERE t >= '2024-01-05' AND t < '2024-01-12'", "obs_long")
def load_stac(spark, d):
    o = view(spark, d, "obs_long")
    href = F.concat(F.lit("a/"), F.col("obs_id").cast("string"))
    items = o.select(F.col("obs_id").alias("id"), F.col("t").alias("datetime"), F.create_map(F.col("band"), href).alias("assets"))
    got = files.load_stac(spark, items, o.select(href.alias("href"), "value"), "2024-01-05", "2024-01-12")
    return got.select(F.col("id").alias("obs_id"), "band", "value")


@query("read_stac_items", "SELECT 'i' || obs_id AS id, band, 'a/' || obs_id AS href FROM obs_long WHERE t >= '2024-01-05' AND t < '2024-01-20' AND x <= 9 AND x + 1 >= 4 AND y <= 6 AND y + 1 >= 0 AND band <> 'click'", "obs_long")
def read_stac_items(spark, d):
    """Items are written as JSON and read back by time, box and band."""
    root = _shared(spark) + "/stac"
    o = view(spark, d, "obs_long")
    box = F.array(*[F.col(c).cast("double") + i for i in (0, 1) for c in ("x", "y")])
    assets = F.create_map(F.col("band"), F.struct(F.concat(F.lit("a/"), F.col("obs_id").cast("string")).alias("href")))
    o.select(F.concat(F.lit("i"), F.col("obs_id").cast("string")).alias("id"), box.alias("bbox"), F.struct(F.col("t").cast("timestamp").alias("datetime")).alias("properties"), assets.alias("assets")).write.json(root)
    bands = [r.band for r in o.select("band").distinct().where("band <> 'click'").collect()]  # the few bands of the cube
    return files.read_stac(spark, root, "2024-01-05", "2024-01-20", (4, 0, 9, 6), bands).select("id", "band", "href")


def _database(spark) -> tuple[str, dict]:
    """The database that spark.pixelloom.jdbc.url names; without one a local session uses the one embedded in Spark's libraries."""
    url = spark.conf.get("spark.pixelloom.jdbc.url", None)
    if url:
        return url, {}
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.pixelloom.jdbc.url must name a database")
    return "jdbc:derby:memory:pixelloom;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _table(spark, d) -> tuple[str, dict, str]:
    """The job tracker as a new table of the database, its cost NaN for every tenth id."""
    import uuid

    (url, more), name = _database(spark), f"T{uuid.uuid4().hex[:20]}"
    cost = F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("cost"))
    files.jdbc_insert(view(spark, d, "job_tracker").select("id", "status", cost.alias("cost")), url, name, **more)
    return url, more, name


@query("jdbc_bulk_insert", rounds("SELECT id, status, CASE WHEN id % 10 <> 0 THEN cost END AS cost FROM job_tracker", "cost", 3), "job_tracker")
def jdbc_bulk_insert(spark, d):
    url, more, name = _table(spark, d)
    return rounded(files.jdbc_read(spark, url, name, ["id", "status", "cost"], **more), 3)


@query("jdbc_read", "SELECT id, status FROM job_tracker", "job_tracker")
def jdbc_read(spark, d):
    url, more, name = _table(spark, d)
    return files.jdbc_read(spark, url, name, ["id", "status"], key="id", **more)


@query("jdbc_query", "SELECT status, count(*) AS n, count(CASE WHEN id % 10 <> 0 THEN 1 END) AS with_cost FROM job_tracker GROUP BY status", "job_tracker")
def jdbc_query(spark, d):
    url, more, name = _table(spark, d)
    rows = files.jdbc_query(spark, url, f'SELECT s, count(*) AS n, count("cost") AS with_cost FROM (SELECT CAST("status" AS VARCHAR(40)) AS s, "cost" FROM {name}) v GROUP BY s', **more)
    return rows.select(F.col("S").alias("status"), F.col("N").cast("long").alias("n"), F.col("WITH_COST").cast("long").alias("with_cost"))


@query("jdbc_upsert", rounds("SELECT id, status, CASE WHEN id % 3 = 0 THEN cost + 1 WHEN id % 10 <> 0 THEN cost END AS cost FROM job_tracker UNION ALL SELECT -id, 'created', CAST(attempt AS DOUBLE) FROM job_tracker WHERE id % 4 = 0 AND id > 0", "cost", 3), "job_tracker")
def jdbc_upsert(spark, d):
    """A third of the jobs get a new cost, nulls change nothing, new ids are added; written twice."""
    url, more, name = _table(spark, d)
    j = view(spark, d, "job_tracker")
    new = F.when(F.col("id") % 3 == 0, F.col("cost") + 1)
    added = j.where("id % 4 = 0 AND id > 0").select((-F.col("id")).alias("id"), F.lit("created").alias("status"), F.col("attempt").cast("double").alias("cost"))
    for _ in range(2):
        files.jdbc_upsert(j.select("id", F.lit(None).cast("string").alias("status"), new.alias("cost")).unionByName(added), url, name, "id", **more)
    return rounded(files.jdbc_query(spark, url, f'SELECT "id", "status", "cost" FROM {name}', key="id", **more), 3)


# Streams: their results equal the batch results.
def _events(spark, d):
    import os

    return spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).parquet(f"{d}/events.parquet" if os.path.isdir(f"{d}/events.parquet") else f"{d}/events.parquet*")


@query("stream_period_composite", rounds("SELECT x, y, make_date(year(t), month(t), 1 + 10 * least((day(t) - 1) // 10, 2)) AS t, median(value) AS value FROM obs_long GROUP BY ALL", "value", 4), "obs_long")
def stream_period_composite(spark, d):
    from pixelloom.streaming import jobs as streams

    root = _shared(spark)
    rows = _events(spark, d).selectExpr("CAST(user_id % 16 AS INT) AS x", "CAST(floor(user_id / 16.0) AS INT) AS y", "CAST(ts AS TIMESTAMP) AS t", "value")
    streams.composite_stream(rows, ["value"], "dekad", "median", f"{root}/store", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return rounded(streams.latest_composites(spark, f"{root}/out", ["value"]), 4)


@query("stream_job_status", "SELECT user_id AS id, arg_max(event_type, (ts, event_type)) AS status, count(*) AS n_reports FROM events GROUP BY user_id")
def stream_job_status(spark, d):
    from pixelloom.streaming import jobs as streams

    root = _shared(spark)
    rows = _events(spark, d).selectExpr("user_id AS id", "event_type AS status", "CAST(ts AS TIMESTAMP) AS t")
    streams.status_stream(rows, f"{root}/status", f"{root}/checkpoint").awaitTermination()
    return streams.latest_status(spark, f"{root}/status").select("id", "status", "n_reports")


_REPORTS = """SELECT user_id AS id, ts AS t, CASE CAST(event_id % 7 AS INT) WHEN 0 THEN 'error' WHEN 1 THEN 'running' WHEN 2 THEN 'canceled' ELSE 'finished' END AS status,
    CASE WHEN event_id % 35 = 0 THEN 'OOM' END AS reason, event_id % 11 = 0 AS downloaded FROM events"""
#: The rules of a job's reports, one report a step: r is the next report, j the job before it.
_FOLD = f"""WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, status, coalesce(reason, ''), downloaded) AS i FROM ({_REPORTS})),
j AS (SELECT DISTINCT id, 0::BIGINT AS i, 'created' AS status, 1 AS attempt, NULL::TIMESTAMP AS since FROM r
UNION ALL SELECT id, i, s, CASE WHEN s = 'not_started' OR (p = 'downloading' AND s = 'running') THEN attempt + 1 ELSE attempt END,
    CASE WHEN s = 'downloading' AND p = 'downloading' THEN since WHEN s = 'downloading' THEN t END
FROM (SELECT r.id, r.i, r.t, j.attempt, j.since, j.status AS p, CASE
    WHEN j.status = 'downloading' AND NOT r.downloaded AND coalesce(r.t - j.since > INTERVAL 2 DAY * j.attempt, FALSE) THEN CASE WHEN j.attempt <= 5 THEN 'running' ELSE 'error_downloading' END
    WHEN (j.status = 'downloading' AND NOT r.downloaded) OR (j.status <> 'downloading' AND r.status = 'finished') THEN 'downloading'
    WHEN r.status = 'error' THEN coalesce(r.reason, CASE WHEN j.attempt <= 3 THEN 'not_started' ELSE 'error_openeo' END)
    WHEN r.status = 'canceled' AND j.attempt <= 3 THEN 'not_started' ELSE r.status END AS s
    FROM j JOIN r ON r.id = j.id AND r.i = j.i + 1 WHERE j.status IN ('created', 'queued', 'queued_for_start', 'running', 'downloading', 'not_started')) x)
SELECT id, arg_max(status, i) AS status, arg_max(attempt, i) AS attempt, max(i) AS n_reports FROM j GROUP BY id"""


@query("fold_job_reports", _FOLD)
def fold_job_reports(spark, d):
    return jobs.fold_reports(spark.read.parquet(f"{d}/events.parquet").selectExpr(*_report_columns()), 2 * 86_400).select("id", "status", "attempt", "n_reports")


def _report_columns() -> list[str]:
    kinds = "CASE CAST(event_id % 7 AS INT) WHEN 0 THEN 'error' WHEN 1 THEN 'running' WHEN 2 THEN 'canceled' ELSE 'finished' END"
    return ["user_id AS id", "CAST(ts AS TIMESTAMP) AS t", f"{kinds} AS status", "CASE WHEN event_id % 35 = 0 THEN 'OOM' END AS reason", "event_id % 11 = 0 AS downloaded"]


@query("stream_job_attempts", _FOLD)
def stream_job_attempts(spark, d):
    """The reports come in two parts, by time; the stream ends after the first and is started anew from its checkpoint."""
    from pixelloom.streaming import jobs as streams

    root = _shared(spark)
    rows = spark.read.parquet(f"{d}/events.parquet").selectExpr(*_report_columns())
    middle = rows.agg(F.timestamp_micros(((F.min(F.unix_micros("t")) + F.max(F.unix_micros("t"))) / 2).cast("long"))).first()[0]
    for part in (F.col("t") < F.lit(middle), F.col("t") >= F.lit(middle)):
        rows.where(part).write.mode("append").parquet(f"{root}/reports")
        reports = spark.readStream.schema(rows.schema).parquet(f"{root}/reports")
        streams.attempts_stream(reports, 2 * 86_400, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return streams.latest_attempts(spark, f"{root}/out").select("id", "status", "attempt", "n_reports")


@query("stream_dedup_items", "SELECT count(DISTINCT event_id) AS n FROM events")
def stream_dedup_items(spark, d):
    import uuid

    from pixelloom.streaming import jobs as streams

    root = _shared(spark)
    rows = _events(spark, d).selectExpr("event_id AS id", "CAST(ts AS TIMESTAMP) AS t")
    once = streams.first_items(rows.unionByName(rows), ["id"], "60 days")
    once.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").agg(F.count("*").alias("n"))


@query("parquet_kv_metadata", "SELECT id, 'B' || tile_id AS first_band, attempt AS version FROM job_tracker", "job_tracker")
def parquet_kv_metadata(spark, d):
    j = view(spark, d, "job_tracker")
    bands = F.format_string('{"bands": ["B%d", "x"]}', "tile_id")
    pairs = j.select("id", F.lit("model").alias("key"), bands.alias("value")).unionByName(j.select("id", F.lit("info").alias("key"), F.format_string('{"version": %d}', "attempt").alias("value")))
    kv = pairs.groupBy("id").agg(text.metadata_map(F.col("key"), F.col("value")).alias("kv"))
    model, info = text.metadata_field(F.col("kv"), "model", "bands array<string>"), text.metadata_field(F.col("kv"), "info", "version int")
    return kv.select("id", model["bands"][0].alias("first_band"), info["version"].alias("version"))


@query("read_xml_tiles", "SELECT lpad(CAST(zone_number AS VARCHAR), 2, '0') || 'U' || point_id AS tile_id, 32600 + zone_number AS epsg FROM ref_points WHERE zone_number IN (31, 32, 33)", "ref_points")
def read_xml_tiles(spark, d):
    root = _shared(spark) + "/kml"
    mark = F.format_string("<Placemark><name>%02dU%d</name><description>EPSG 326%02d POLYGON((0 0,1 0,1 1,0 0))</description></Placemark>", "zone_number", "point_id", "zone_number")
    rows = view(spark, d, "ref_points").select("zone_number", F.floor(F.col("point_id") / 60_000).alias("part"), mark.alias("mark"))
    documents = rows.groupBy("zone_number", "part").agg(F.array_join(F.collect_list("mark"), "\n").alias("marks"))  # about 1,000 marks each
    documents.select(F.concat(F.lit("<kml>"), "marks", F.lit("</kml>"))).write.option("maxRecordsPerFile", 1).text(root)
    return files.read_xml_tiles(spark, root, [31, 32, 33]).select("tile_id", "epsg")
