"""Queries along time: composites, reducers, statistics, interpolation, and the cube pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelloom.operators import classify, joins, temporal
from pixelloom.plans import cube
from pixelloom.plans.queries_pixel import INDEX_SQL
from pixelloom.plans.registry import query, rounded, rounds, with_rounds
from pixelloom.plans.views import view

PERIOD_SQL = {
    "day": "CAST(t AS DATE)", "week": "CAST(date_trunc('week', t) AS DATE)", "month": "CAST(date_trunc('month', t) AS DATE)", "year": "CAST(date_trunc('year', t) AS DATE)",
    "dekad": "make_date(year(t), month(t), 1 + 10 * least((day(t) - 1) // 10, 2))", "season": "CAST(date_trunc('quarter', t + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE)",
}
REDUCER_SQL = {
    "median": "median({v})", "mean": "avg({v})", "max": "max({v})", "min": "min({v})", "first": "arg_min({v}, (t, {v})) FILTER ({v} IS NOT NULL)", "last": "arg_max({v}, (t, {v})) FILTER ({v} IS NOT NULL)",
    "product": "product({v})", "sd": "stddev_samp({v})", "sum": "sum({v})", "variance": "var_samp({v})",
}


def _period_query(period: str) -> None:
    @query(f"agg_period_{period}", rounds(f"SELECT x, y, {PERIOD_SQL[period]} AS t, median(B04) AS B04, median(B08) AS B08 FROM refl_wide GROUP BY ALL", "B04 B08", 3), "refl_wide")
    def one(spark, d):
        return rounded(temporal.composite(view(spark, d, "refl_wide"), ["B04", "B08"], period, "median"), 3)


def _reducer_query(name: str) -> None:
    v = "(1 + B11 / 1e6)"
    body = REDUCER_SQL[name].replace("{v}", "v")

    @query(f"red_{name}", rounds(f"SELECT x, y, {PERIOD_SQL['month']} AS t, {body} AS v FROM (SELECT x, y, t, CASE WHEN scl < 9 THEN {v} END AS v FROM refl_wide) GROUP BY ALL", "v", 7), "refl_wide")
    def one(spark, d):
        rows = view(spark, d, "refl_wide").select("x", "y", "t", F.when(F.col("scl") < 9, 1 + F.col("B11") / 1e6).alias("v"))
        return rounded(temporal.composite(rows, ["v"], "month", name), 7)


for _p in temporal.PERIODS:
    _period_query(_p)
for _r in REDUCER_SQL:
    _reducer_query(_r)

_MONTHLY = f"c AS (SELECT x, y, {PERIOD_SQL['month']} AS t, avg(B04) AS B04 FROM refl_wide GROUP BY ALL)"
_DENSE = f"{_MONTHLY}, p AS (SELECT x, y, CAST(m AS DATE) AS t FROM (SELECT DISTINCT x, y FROM c), range(DATE '1992-01-01', DATE '2002-01-01', INTERVAL 1 MONTH) r(m)), dense AS (SELECT p.x, p.y, p.t, c.B04 FROM p LEFT JOIN c USING (x, y, t))"


def _dense(spark, d):
    rows = cube.load(view(spark, d, "refl_wide"), ("B04",), "1992-01-01", "2002-01-01")  # all of the table
    return temporal.densify(temporal.composite(rows, ["B04"], "month", "mean"), "1992-01-01", "2002-01-01", "month")


@query("densify_periods", with_rounds(_DENSE, "SELECT * FROM dense", "B04", 3), "refl_wide")
def densify_periods(spark, d):
    return rounded(_dense(spark, d), 3)


@query("interpolate_linear", with_rounds(
    f"{_DENSE}, n AS (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY t) AS i FROM dense), k AS (SELECT * FROM n WHERE B04 IS NOT NULL)",
    """SELECT n.x, n.y, n.t, coalesce(n.B04, a.B04 + (b.B04 - a.B04) * (n.i - a.i) / nullif(b.i - a.i, 0)) AS B04 FROM n
    LEFT JOIN k a ON a.x = n.x AND a.y = n.y AND a.i = (SELECT max(i) FROM k WHERE k.x = n.x AND k.y = n.y AND k.i <= n.i)
    LEFT JOIN k b ON b.x = n.x AND b.y = n.y AND b.i = (SELECT min(i) FROM k WHERE k.x = n.x AND k.y = n.y AND k.i >= n.i)""", "B04", 3), "refl_wide")
def interpolate_linear(spark, d):
    return rounded(temporal.interpolate(_dense(spark, d), ["B04"]), 3)


def _stats(bands, source: str = "", expr=lambda b: b) -> str:
    """The nine statistics as a select list."""
    out = []
    for b in bands:
        q = lambda p, b=b: f"quantile_cont({expr(b)}, {p})"
        n = lambda s, b=b: f'"{b}_{s}"'
        out += [f"{q(0.02)} AS {n('p2')}", f"{q(0.25)} AS {n('p25')}", f"{q(0.5)} AS {n('median')}", f"{q(0.75)} AS {n('p75')}", f"{q(0.98)} AS {n('p98')}", f"avg({expr(b)}) AS {n('mean')}", f"stddev_samp({expr(b)}) AS {n('sd')}", f"sum({expr(b)}) AS {n('sum')}", f"{q(0.75)} - {q(0.25)} AS {n('iqr')}"]
    return ", ".join(out)


def _names(bands) -> str:
    return " ".join(f"{b}_{s}" for b in bands for s in temporal.FEATURES if f"{b}_{s}" not in cube.MEANINGLESS)


@query("temporal_features", rounds(f"SELECT x, y, {_stats(['B04', 'VV'])} FROM refl_wide GROUP BY x, y", " ".join(f"{b}_{s}" for b in ("B04", "VV") for s in temporal.FEATURES), 3), "refl_wide")
def temporal_features(spark, d):
    return rounded(temporal.temporal_features(view(spark, d, "refl_wide"), ["B04", "VV"]), 3)


_S8 = "avg(B08) AS B08_mean, median(B08) AS B08_median, min(B08) AS B08_min, max(B08) AS B08_max, quantile_cont(B08, 0.05) AS B08_q05, quantile_cont(B08, 0.25) AS B08_q25, quantile_cont(B08, 0.75) AS B08_q75, quantile_cont(B08, 0.95) AS B08_q95"


@query("temporal_stats_8", rounds(f"SELECT x, y, {_S8} FROM refl_wide GROUP BY x, y", " ".join(f"B08_{s}" for s in temporal.STATS8), 3), "refl_wide")
def temporal_stats_8(spark, d):
    return rounded(temporal.temporal_stats8(view(spark, d, "refl_wide"), ["B08"]), 3)


@query("reduce_last", rounds("SELECT x, y, arg_max(v, (t, v)) FILTER (v IS NOT NULL) AS v FROM (SELECT x, y, t, CASE WHEN scl <> 5 THEN B02 END AS v FROM refl_wide) GROUP BY x, y", "v"), "refl_wide")
def reduce_last(spark, d):
    rows = view(spark, d, "refl_wide").select("x", "y", "t", F.when(F.col("scl") != 5, F.col("B02")).alias("v"))
    return rounded(rows.groupBy("x", "y").agg(temporal.reducers()["last"](F.col("v")).alias("v")))


@query("stac_order_by_time", "SELECT band, arg_min(obs_id, (t, obs_id)) AS first_item, arg_max(obs_id, (t, obs_id)) AS last_item FROM obs_long GROUP BY band", "obs_long")
def stac_order_by_time(spark, d):
    at = F.struct("t", "obs_id")
    return view(spark, d, "obs_long").groupBy("band").agg(F.min_by("obs_id", at).alias("first_item"), F.max_by("obs_id", at).alias("last_item"))


_C1 = f"a AS (SELECT x, y, {PERIOD_SQL['month']} AS t, avg(VV) AS VV FROM refl_wide WHERE scl <= 6 GROUP BY ALL), b AS (SELECT x, y, {PERIOD_SQL['month']} AS t, avg(B04) AS B04 FROM refl_wide WHERE scl >= 4 GROUP BY ALL)"


@query("merge_cubes", with_rounds(_C1, "SELECT coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, coalesce(a.t, b.t) AS t, VV, B04 FROM a FULL JOIN b ON a.x = b.x AND a.y = b.y AND a.t = b.t", "VV B04"), "refl_wide")
def merge_cubes(spark, d):
    v = view(spark, d, "refl_wide")
    return rounded(joins.merge_cubes(temporal.composite(v.where("scl <= 6"), ["VV"], "month", "mean"), temporal.composite(v.where("scl >= 4"), ["B04"], "month", "mean")))


@query("merge_static", with_rounds("f AS (SELECT x, y, avg(B08) AS B08 FROM refl_wide GROUP BY x, y)", "SELECT f.x, f.y, B08, dem, soc FROM f LEFT JOIN static_cube USING (x, y)", "B08 dem soc", 3), "refl_wide static_cube")
def merge_static(spark, d):
    f = view(spark, d, "refl_wide").groupBy("x", "y").agg(F.avg("B08").alias("B08"))
    return rounded(joins.merge_static(f, view(spark, d, "static_cube")), 3)


_POINTS = "p AS (SELECT point_id, CAST(point_id % 40 AS INT) AS x, CAST(point_id % 50 AS INT) AS y FROM ref_points)"


@query("aggregate_spatial_first", with_rounds(_POINTS, "SELECT point_id, arg_min(B04, (t, B04)) AS B04 FROM p JOIN refl_wide USING (x, y) GROUP BY point_id", "B04"), "ref_points refl_wide")
def aggregate_spatial_first(spark, d):
    p = view(spark, d, "ref_points").select("point_id", (F.col("point_id") % 40).cast("int").alias("x"), (F.col("point_id") % 50).cast("int").alias("y"))
    return rounded(joins.sample_first(p, "point_id", view(spark, d, "refl_wide").select("x", "y", "t", "B04"), ["B04"], ["t"]))


@query("percentile_stretch", rounds("SELECT x, y, (least(greatest(dem, lo), hi) - lo) / (hi - lo) AS dem FROM static_cube, (SELECT quantile_cont(dem, 0.02) AS lo, quantile_cont(dem, 0.98) AS hi FROM static_cube)", "dem"), "static_cube")
def percentile_stretch(spark, d):
    return rounded(classify.percentile_stretch(view(spark, d, "static_cube").select("x", "y", "dem"), ["dem"]))


# The pipelines. Their oracles share these steps.
DN_SQL = "least(greatest(pow(10, (10 * log10({v}) + 83) / 20), 1.0), 65534.0)"
_S1 = f"s1 AS (SELECT x, y, t, {DN_SQL.format(v='a')} AS VV, {DN_SQL.format(v='b')} AS VH FROM (SELECT x, y, {PERIOD_SQL['dekad']} AS t, avg(VV) AS a, avg(VH) AS b FROM refl_wide GROUP BY ALL))"
_S2_MASK = "CASE WHEN scl IN (0, 1, 3, 8, 9, 10, 11) THEN NULL ELSE {b} END"
_S2 = f"s2 AS (SELECT x, y, {PERIOD_SQL['dekad']} AS t, {', '.join(f'median({_S2_MASK.format(b=b)}) AS {b}' for b in cube.S2_BANDS)} FROM refl_wide WHERE cloud_cover <= 95 GROUP BY ALL)"
_S1I = "s1i AS (SELECT x, y, t, VV, VH, 4 * VH / nullif(VV + VH, 0) AS RVI, VH - VV AS VHVVD, VH / nullif(VV, 0) AS VHVVR FROM (SELECT x, y, t, 20 * log10(VV) - 83 AS VV, 20 * log10(VH) - 83 AS VH FROM s1))"
_S2I = f"s2i AS (SELECT x, y, t, {', '.join(cube.S2_BANDS)}, {', '.join(f'{e} AS {n}' for n, e in INDEX_SQL.items())} FROM s2)"
_R = ("VV", "VH", "RVI", "VHVVD", "VHVVR")
_OPT = (*cube.S2_BANDS, *INDEX_SQL)
_FULL = cube.options("feature", masking="classes")


def _obs(spark, d):
    return view(spark, d, "refl_wide")


@query("s1_cube", with_rounds(_S1, "SELECT * FROM s1", "VV VH", 3), "refl_wide")
def s1_cube(spark, d):
    return rounded(cube.s1_cube(_obs(spark, d), _FULL), 3)


@query("s2_cube", with_rounds(_S2, "SELECT * FROM s2", " ".join(cube.S2_BANDS), 3), "refl_wide")
def s2_cube(spark, d):
    return rounded(cube.s2_cube(_obs(spark, d), _FULL), 3)


# The masks at their default sizes over all scenes; a scene holds few pixels, so comparing all pairs of one is cheap.
_SCENE = "sc AS MATERIALIZED (SELECT x, y, t, max(scl) AS scl FROM refl_wide WHERE cloud_cover <= 95 GROUP BY x, y, t)"


def _scene_disk(name: str, flag: str, source: str, r: int, erode: bool = False) -> str:
    n = "NOT " if erode else ""
    return f"{name} AS MATERIALIZED (SELECT a.x, a.y, a.t, {n}coalesce(bool_or({n}({flag.format(s='b')})), FALSE) AS f FROM {source} a LEFT JOIN {source} b ON a.t = b.t AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= {r * r} GROUP BY a.x, a.y, a.t)"


def _scene_square(name: str, source: str, k: int) -> str:
    return f"{name} AS MATERIALIZED (SELECT a.x, a.y, a.t, bool_or(b.f) AS f FROM {source} a JOIN {source} b ON a.t = b.t AND abs(a.x - b.x) <= {k // 2} AND abs(a.y - b.y) <= {k // 2} GROUP BY a.x, a.y, a.t)"


_SATIO_MASK = f"{_SCENE}, {_scene_disk('er', '{s}.scl IN (0, 1, 3, 8, 9, 10, 11)', 'sc', 3, True)}, {_scene_disk('di', '{s}.f', 'er', 21)}"
_DILATION_MASK = f"{_SCENE}, {_scene_disk('oe', '{s}.scl NOT IN (2, 4, 5, 6, 7)', 'sc', 3, True)}, {_scene_disk('ce', '{s}.scl IN (3, 8, 9, 10, 11)', 'sc', 3, True)}, {_scene_square('od', 'oe', 17)}, {_scene_square('cd', 'ce', 77)}, di AS (SELECT x, y, t, od.f OR cd.f AS f FROM od JOIN cd USING (x, y, t))"
_MASKED = "SELECT x, y, {period} AS t, {bands} FROM refl_wide JOIN di USING (x, y, t) WHERE cloud_cover <= 95 GROUP BY ALL"
_S2_SATIO = f"{_SATIO_MASK}, s2 AS ({_MASKED.format(period=PERIOD_SQL['dekad'], bands=', '.join(f'median(CASE WHEN f THEN NULL ELSE {b} END) AS {b}' for b in cube.S2_BANDS))})"
_SATIO = cube.options("feature", masking="satio")


@query("s2_cube_satio", with_rounds(_SATIO_MASK, _MASKED.format(period=PERIOD_SQL["month"], bands="median(CASE WHEN f THEN NULL ELSE B04 END) AS B04"), "B04", 3), "refl_wide")
def s2_cube_satio(spark, d):
    return rounded(cube.s2_cube(_obs(spark, d), cube.options("feature", masking="satio", ts_interval="month"), ("B04",)), 3)


@query("s2_cube_scl_dilation", with_rounds(_DILATION_MASK, _MASKED.format(period=PERIOD_SQL["month"], bands="median(CASE WHEN f THEN NULL ELSE B04 END) AS B04"), "B04", 3), "refl_wide")
def s2_cube_scl_dilation(spark, d):
    return rounded(cube.s2_cube(_obs(spark, d), cube.options("feature", masking="mask_scl_dilation", ts_interval="month"), ("B04",)), 3)


@query("planet_cube", rounds(f"SELECT x, y, {PERIOD_SQL['dekad']} AS t, median(CASE WHEN scl = 4 THEN B04 END) AS B04, median(CASE WHEN scl = 4 THEN B08 END) AS B08 FROM refl_wide GROUP BY ALL", "B04 B08", 3), "refl_wide")
def planet_cube(spark, d):
    rows = _obs(spark, d).withColumn("udm2", F.when(F.col("scl") == 4, 1).otherwise(2))
    return rounded(cube.planet_cube(rows, ["B04", "B08"]), 3)


@query("ts_cube", with_rounds(f"{_S1}, {_S2}", f"SELECT coalesce(s1.x, s2.x) AS x, coalesce(s1.y, s2.y) AS y, coalesce(s1.t, s2.t) AS t, VV, VH, {', '.join(cube.S2_BANDS)} FROM s1 FULL JOIN s2 ON s1.x = s2.x AND s1.y = s2.y AND s1.t = s2.t", " ".join(["VV", "VH", *cube.S2_BANDS]), 3), "refl_wide")
def ts_cube(spark, d):
    return rounded(cube.ts_cube(_obs(spark, d), _obs(spark, d), _FULL), 3)


@query("s1_indices", with_rounds(f"{_S1}, {_S1I}", "SELECT * FROM s1i", " ".join(_R)), "refl_wide")
def s1_indices(spark, d):
    return rounded(cube.s1_indices(cube.s1_cube(_obs(spark, d), _FULL), _FULL))


@query("s2_indices", with_rounds(f"{_S2}, {_S2I}", "SELECT * FROM s2i", " ".join(_OPT), 3), "refl_wide")
def s2_indices(spark, d):
    return rounded(cube.s2_indices(cube.s2_cube(_obs(spark, d), _FULL), _FULL), 3)


_PB = ("B02", "B04", "B06", "B07", "B08")
_PL = f"pl AS (SELECT x, y, {PERIOD_SQL['dekad']} AS t, {', '.join(f'median(CASE WHEN scl = 4 THEN {b} END) AS {b}' for b in _PB)} FROM refl_wide GROUP BY ALL)"
_PLI = "pli AS (SELECT x, y, t, (B08 - B06) / nullif(B08 + B06, 0) AS NDVI, (B04 - B08) / nullif(B04 + B08, 0) AS NDWI FROM (SELECT x, y, t, B04 / 10000 AS B04, B06 / 10000 AS B06, B08 / 10000 AS B08 FROM pl))"


def _planet(spark, d):
    rows = _obs(spark, d).withColumn("udm2", F.when(F.col("scl") == 4, 1).otherwise(2))
    return cube.planet_indices(cube.planet_cube(rows, _PB), ["NDVI", "NDWI"])


@query("planet_indices_cube", with_rounds(f"{_PL}, {_PLI}", "SELECT * FROM pli", "NDVI NDWI"), "refl_wide")
def planet_indices_cube(spark, d):
    return rounded(_planet(spark, d))


@query("master_indices", with_rounds(f"{_S1}, {_S2}, {_S1I}, {_S2I}", f"SELECT coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, coalesce(a.t, b.t) AS t, {', '.join((*_R, *_OPT))} FROM s1i a FULL JOIN s2i b ON a.x = b.x AND a.y = b.y AND a.t = b.t", " ".join((*_R, *_OPT)), 3), "refl_wide")
def master_indices(spark, d):
    return rounded(cube.master_indices(_obs(spark, d), _obs(spark, d), _FULL), 3)


def _feature_sql(bands, source: str) -> str:
    drop = ", ".join(f'"{b}_{s}"' for b in bands for s in temporal.FEATURES if f"{b}_{s}" in cube.MEANINGLESS)
    return f"SELECT * {f'EXCLUDE ({drop})' if drop else ''} FROM (SELECT x, y, {_stats(bands)} FROM {source} GROUP BY x, y)"


@query("s1_features", with_rounds(f"{_S1}, {_S1I}", _feature_sql(_R, "s1i"), _names(_R), 3), "refl_wide")
def s1_features(spark, d):
    return rounded(cube.s1_features(_obs(spark, d), _FULL), 3)


@query("s2_features", with_rounds(f"{_S2}, {_S2I}", _feature_sql(_OPT, "s2i"), _names(_OPT), 2), "refl_wide")
def s2_features(spark, d):
    return rounded(cube.s2_features(_obs(spark, d), _FULL), 2)


@query("s2_features_satio", with_rounds(f"{_S2_SATIO}, {_S2I}", _feature_sql(_OPT, "s2i"), _names(_OPT), 2), "refl_wide")
def s2_features_satio(spark, d):
    """The feature cube with the default mask."""
    return rounded(cube.s2_features(_obs(spark, d), _SATIO), 2)


@query("planet_features", with_rounds(f"{_PL}, {_PLI}", _feature_sql(("NDVI", "NDWI"), "pli"), _names(("NDVI", "NDWI"))), "refl_wide")
def planet_features(spark, d):
    return rounded(cube.features(_planet(spark, d)))


@query("master_features", with_rounds(f"{_S1}, {_S2}, {_S1I}, {_S2I}, fa AS ({_feature_sql(_R, 's1i')}), fb AS ({_feature_sql(_OPT, 's2i')})", "SELECT * FROM fa FULL JOIN fb USING (x, y)", f"{_names(_R)} {_names(_OPT)}", 2), "refl_wide")
def master_features(spark, d):
    return rounded(cube.master_features(_obs(spark, d), _obs(spark, d), _FULL), 2)


@query("master_features_satio", with_rounds(f"{_S1}, {_S2_SATIO}, {_S1I}, {_S2I}, fa AS ({_feature_sql(_R, 's1i')}), fb AS ({_feature_sql(_OPT, 's2i')})", "SELECT * FROM fa FULL JOIN fb USING (x, y)", f"{_names(_R)} {_names(_OPT)}", 2), "refl_wide")
def master_features_satio(spark, d):
    return rounded(cube.master_features(_obs(spark, d), _obs(spark, d), _SATIO), 2)


@query("flagship_ndvi_features", with_rounds(f"{_S2}, n AS (SELECT x, y, t, {INDEX_SQL['NDVI']} AS NDVI FROM s2)", f"SELECT x, y, {_stats(['NDVI'])} FROM n GROUP BY x, y", _names(["NDVI"]), 5), "refl_wide")
def flagship_ndvi_features(spark, d):
    opt = cube.options("feature", masking="classes", optical=("NDVI",), append=False)
    scenes = cube.s2_cube(_obs(spark, d), opt, ("B04", "B08"))
    from pixelloom.functions.indices import optical

    return rounded(cube.features(scenes.select("x", "y", "t", *optical(["NDVI"], {"R": "B04", "N": "B08"}, scale=10_000))), 5)


@query("filter_feature_bands", "WITH kept AS (SELECT b || '_' || s AS column_name FROM (VALUES ('VV'), ('VH'), ('RVI'), ('VHVVD'), ('VHVVR')) v(b), (VALUES ('p2'), ('p25'), ('median'), ('p75'), ('p98'), ('mean'), ('sd'), ('sum'), ('iqr')) w(s) WHERE b || '_' || s NOT IN ('VV_sum', 'VH_sum', 'VHVVD_sum')), n AS (SELECT count(DISTINCT (x, y)) AS n_pixels FROM refl_wide) SELECT column_name, n_pixels FROM kept, n", "refl_wide")
def filter_feature_bands(spark, d):
    """The names of the bands that are kept, each with the pixels that it has."""
    kept = cube.s1_features(_obs(spark, d), _FULL)
    cube.check_bands(kept, ["VV_mean", "VV_iqr"])
    names = [c for c in kept.columns if c not in ("x", "y")]
    counts = kept.agg(*[F.count("*").alias(c) for c in names])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_pixels")) for c in names])).alias("k")).select("k.column_name", "k.n_pixels")


@query("minmax_scale", rounds("SELECT x, y, coalesce((dem - min(dem) OVER w) / nullif(max(dem) OVER w - min(dem) OVER w, 0), 0) AS dem FROM static_cube WINDOW w AS (PARTITION BY x // 16, y // 16)", "dem"), "static_cube")
def minmax_scale(spark, d):
    v = view(spark, d, "static_cube").select("x", "y", "dem", F.floor(F.col("x") / 16).alias("cx"), F.floor(F.col("y") / 16).alias("cy"))
    return rounded(classify.minmax(v, ["dem"], ["cx", "cy"]).select("x", "y", "dem"))
