"""Queries of pixel expressions, indices and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelloom.functions import indices, pixel
from pixelloom.operators import spatial
from pixelloom.plans import cube
from pixelloom.plans.registry import query, rounded, rounds
from pixelloom.plans.views import view

DAY = "CAST(t AS DATE) AS t"


def _day(df):
    return df.withColumn("t", F.to_date("t"))


@query("load_collection", f"SELECT x, y, {DAY}, VV, VH FROM refl_wide WHERE t >= '1997-01-01' AND t < '1998-01-01' AND x BETWEEN 5 AND 20 AND y BETWEEN 0 AND 30", "refl_wide")
def load_collection(spark, d):
    return _day(cube.load(view(spark, d, "refl_wide"), cube.S1_BANDS, "1997-01-01", "1998-01-01", (5, 0, 20, 30)))


@query("load_collection_s2", f"SELECT x, y, {DAY}, B04, B08 FROM refl_wide WHERE t >= '1997-01-01' AND t < '1998-01-01' AND cloud_cover <= 40 AND s2_tile IN ('31UES', '31UFS')", "refl_wide")
def load_collection_s2(spark, d):
    return _day(cube.load(view(spark, d, "refl_wide"), ("B04", "B08"), "1997-01-01", "1998-01-01", max_cloud_cover=40, tiles=("31UES", "31UFS")))


@query("filter_orbit_polarisation", "SELECT obs_id, band, orbit_state FROM obs_long WHERE orbit_state = 'DESCENDING'", "obs_long")
def filter_orbit(spark, d):
    return view(spark, d, "obs_long").where(F.col("orbit_state") == "DESCENDING").select("obs_id", "band", "orbit_state")


@query("filter_tile_ids", "SELECT s2_tile, count(*) AS n FROM refl_wide WHERE s2_tile LIKE '31UE%' GROUP BY s2_tile", "refl_wide")
def filter_tile_ids(spark, d):
    return cube.filter_tiles(view(spark, d, "refl_wide"), ("31UE*",)).groupBy("s2_tile").agg(F.count("*").alias("n"))


@query("filter_bands", f"SELECT x, y, {DAY}, B08, B04 FROM refl_wide", "refl_wide")
def filter_bands(spark, d):
    return _day(view(spark, d, "refl_wide")).select("x", "y", "t", "B08", "B04")


@query("filter_temporal", f"SELECT x, y, {DAY}, B02 FROM refl_wide WHERE t >= '1996-03-01' AND t < '1996-04-01'", "refl_wide")
def filter_temporal(spark, d):
    return _day(cube.load(view(spark, d, "refl_wide"), ("B02",), "1996-03-01", "1996-04-01"))


@query("filter_bbox", "SELECT x, y, dem FROM static_cube WHERE x BETWEEN 10 AND 19 AND y BETWEEN 5 AND 24", "static_cube")
def filter_bbox(spark, d):
    return view(spark, d, "static_cube").where(F.col("x").between(10, 19) & F.col("y").between(5, 24)).select("x", "y", "dem")


@query("rename_labels", "SELECT x, y, dem AS elevation, soc AS carbon FROM static_cube", "static_cube")
def rename_labels(spark, d):
    return view(spark, d, "static_cube").toDF("x", "y", "elevation", "carbon")


@query("drop_dimension_t", "SELECT x, y, max(B04) AS B04 FROM refl_wide GROUP BY x, y", "refl_wide")
def drop_dimension_t(spark, d):
    from pixelloom.operators.temporal import drop_t

    one = view(spark, d, "refl_wide").groupBy("x", "y").agg(F.max("B04").alias("B04")).withColumn("t", F.lit("1995-01-01").cast("date"))
    return drop_t(one)


@query("band_select", "SELECT vec_id, p1, p3 AS third FROM class_probs", "class_probs")
def band_select(spark, d):
    stacked = view(spark, d, "class_probs").select("vec_id", "p1", F.array("p1", "p2", "p3").alias("bands"))
    return stacked.select("vec_id", "p1", F.element_at("bands", 2 + 1).alias("third"))


@query("array_create_concat", "SELECT vec_id, list_concat([p1, p2], [p3])[3] AS last_value, len(list_concat([p1, p2], [p3])) AS n FROM class_probs", "class_probs")
def array_create_concat(spark, d):
    v = view(spark, d, "class_probs").select("vec_id", F.concat(F.array("p1", "p2"), F.array("p3")).alias("a"))
    return v.select("vec_id", F.element_at("a", -1).alias("last_value"), F.size("a").cast("long").alias("n"))


@query("linear_scale_range", rounds("SELECT x, y, (least(greatest(dem, 950.0), 1500.0) - 950) / 550 * 65533 + 1 AS dn FROM static_cube", "dn"), "static_cube")
def linear_scale_range(spark, d):
    return rounded(view(spark, d, "static_cube").select("x", "y", pixel.linear_scale(F.col("dem"), 950, 1500, 1, 65534).alias("dn")))


_DN = "least(greatest(pow(10, (10 * log10(VV) + 83) / 20), 1.0), 65534.0)"


@query("s1_power_to_dn", rounds(f"SELECT x, y, {DAY}, {_DN} AS VV FROM refl_wide", "VV"), "refl_wide")
def s1_power_to_dn(spark, d):
    return rounded(_day(view(spark, d, "refl_wide")).select("x", "y", "t", pixel.power_to_dn(F.col("VV")).alias("VV")))


@query("s1_dn_to_db", rounds(f"SELECT x, y, {DAY}, 20 * log10({_DN}) - 83 AS db FROM refl_wide", "db"), "refl_wide")
def s1_dn_to_db(spark, d):
    return rounded(_day(view(spark, d, "refl_wide")).select("x", "y", "t", pixel.dn_to_db(pixel.power_to_dn(F.col("VV"))).alias("db")))


@query("pixel_arithmetic", rounds("SELECT x, y, dem + soc AS a, dem - soc AS b, dem * soc AS c, dem / nullif(soc - 1, 0) AS d, pow(soc, 2) AS e, log10(dem) AS f, dem >= 1000 AND soc <= 25 AS g FROM static_cube", "a b c d e f"), "static_cube")
def pixel_arithmetic(spark, d):
    dem, soc = F.col("dem"), F.col("soc")
    return rounded(view(spark, d, "static_cube").select("x", "y", (dem + soc).alias("a"), (dem - soc).alias("b"), (dem * soc).alias("c"), F.try_divide(dem, soc - 1).alias("d"), F.pow(soc, 2).alias("e"), F.log10(dem).alias("f"), ((dem >= 1000) & (soc <= 25)).alias("g")))


_HOLED = "CASE WHEN scl IN (0, 1, 3, 8, 9, 10, 11) THEN NULL ELSE B04 END"


def _holed(df):
    return df.select("x", "y", "t", "B08", *pixel.mask_bands(["B04"], pixel.scl_bad(F.col("scl"))))


@query("if_is_nodata", f"SELECT x, y, {DAY}, CASE WHEN {_HOLED} IS NULL THEN B08 ELSE {_HOLED} END AS v FROM refl_wide", "refl_wide")
def if_is_nodata(spark, d):
    return _holed(_day(view(spark, d, "refl_wide"))).select("x", "y", "t", F.when(F.col("B04").isNull(), F.col("B08")).otherwise(F.col("B04")).alias("v"))


@query("fill_nodata_zero", rounds(f"SELECT x, y, {DAY}, CAST(CAST(coalesce({_HOLED}, 0) AS FLOAT) AS DOUBLE) AS v FROM refl_wide", "v", 2), "refl_wide")
def fill_nodata_zero(spark, d):
    return rounded(_holed(_day(view(spark, d, "refl_wide"))).na.fill(0.0, ["B04"]).select("x", "y", "t", F.col("B04").cast("float").cast("double").alias("v")), 2)


@query("cast_output", "SELECT vec_id, CAST(floor(least(p1 * 100, 255)) AS INT) AS u8, CAST(floor(p2 * 1000) AS BIGINT) AS u32 FROM class_probs", "class_probs")
def cast_output(spark, d):
    return view(spark, d, "class_probs").select("vec_id", F.floor(F.least(F.col("p1") * 100, F.lit(255.0))).cast("int").alias("u8"), F.floor(F.col("p2") * 1000).alias("u32"))


@query("scl_class_mask", "SELECT x, y, scl, scl IN (0, 1, 3, 8, 9, 10, 11) AS bad FROM scl_raster", "scl_raster")
def scl_class_mask(spark, d):
    return view(spark, d, "scl_raster").select("x", "y", "scl", pixel.scl_bad(F.col("scl")).alias("bad"))


@query("mask_not", "SELECT x, y, NOT (scl IN (0, 1, 3, 8, 9, 10, 11)) AS good, scl / 10.0 > 0.1 AS over FROM scl_raster", "scl_raster")
def mask_not(spark, d):
    return view(spark, d, "scl_raster").select("x", "y", (~pixel.scl_bad(F.col("scl"))).alias("good"), (F.col("scl") / 10.0 > 0.1).alias("over"))


_UDM = "scl % 2 AS clear, CAST(scl = 2 AS INT) AS snow, CAST(scl = 3 AS INT) AS shadow, CAST(scl IN (4, 5) AS INT) AS light, CAST(scl IN (5, 6) AS INT) AS heavy, CAST(scl >= 9 AS INT) AS cloud, scl / 10.0 AS conf"


def _udm(spark, d):
    return view(spark, d, "scl_raster").selectExpr("x", "y", *_UDM.replace("CAST(scl IN (4, 5) AS INT)", "CAST(scl IN (4;5) AS INT)").replace("CAST(scl IN (5, 6) AS INT)", "CAST(scl IN (5;6) AS INT)").replace(", ", "|").replace(";", ",").split("|"))


_UDM_ARGS = ("clear", "snow", "shadow", "light", "heavy", "cloud", "conf")


@query("classify_udm2", f"SELECT x, y, CASE WHEN cloud = 1 THEN 7 WHEN heavy = 1 THEN 6 WHEN light = 1 THEN 5 WHEN shadow = 1 THEN 4 WHEN snow = 1 THEN 3 WHEN conf < 0.8 THEN 2 ELSE 1 END AS class FROM (SELECT x, y, {_UDM} FROM scl_raster)", "scl_raster")
def classify_udm2(spark, d):
    return _udm(spark, d).select("x", "y", pixel.classify_udm2(*map(F.col, _UDM_ARGS)).alias("class"))


@query("udm2_valid_mask", f"SELECT x, y, clear = 1 AND snow = 0 AND shadow = 0 AND light = 0 AND heavy = 0 AND cloud = 0 AND conf >= 0.8 AS valid FROM (SELECT x, y, {_UDM} FROM scl_raster)", "scl_raster")
def udm2_valid_mask(spark, d):
    return _udm(spark, d).select("x", "y", pixel.udm2_valid(*map(F.col, _UDM_ARGS)).alias("valid"))


# Oracle text of the indices over reflectances in 0 to 1.
_B = {k: f"(CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, 0.0), 10000.0) / 10000 END)" for k, c in indices.SENTINEL2.items()}


def _nd(a: str, b: str) -> str:
    return f"(({a}) - ({b})) / nullif(({a}) + ({b}), 0)"


_MEAN = f"(({_B['G']} + {_B['R']} + {_B['S2']}) / 3)"
_P = f"({_B['N']} * (1 - {_B['R']}) * ({_B['N']} - {_B['R']}))"
INDEX_SQL = {
    "NDVI": _nd(_B["N"], _B["R"]), "AVI": f"CASE WHEN {_P} >= 0 THEN pow({_P}, 1.0 / 3) END", "CIRE": f"{_B['N']} / nullif({_B['RE1']}, 0) - 1", "NIRv": f"({_nd(_B['N'], _B['R'])}) * {_B['N']}",
    "NDMI": _nd(_B["N"], _B["S1"]), "NDWI": _nd(_B["G"], _B["N"]), "BLFEI": _nd(_MEAN, _B["S1"]), "MNDWI": _nd(_B["G"], _B["S1"]), "NDVIMNDWI": f"{_nd(_B['N'], _B['R'])} - {_nd(_B['G'], _B['S1'])}",
    "S2WI": _nd(_B["RE1"], _B["S2"]), "S2REP": f"705 + 35 * (({_B['RE3']} + {_B['R']}) / 2 - {_B['RE1']}) / nullif({_B['RE2']} - {_B['RE1']}, 0)",
    "IRECI": f"({_B['RE3']} - {_B['R']}) / nullif({_B['RE1']} / nullif({_B['RE2']}, 0), 0)",
}


def _index_query(name: str) -> None:
    @query(f"vi_{name.lower()}", rounds(f"SELECT x, y, {DAY}, {INDEX_SQL[name]} AS v FROM refl_wide", "v", 7), "refl_wide")
    def one(spark, d):
        return rounded(_day(view(spark, d, "refl_wide")).select("x", "y", "t", *[c.alias("v") for c in indices.optical([name], scale=10_000)]), 7)


for _name in indices.OPTICAL:
    _index_query(_name)


@query("optical_indices", rounds(f"SELECT x, y, {DAY}, B04, B08, {', '.join(f'{e} AS {n}' for n, e in INDEX_SQL.items())} FROM refl_wide", " ".join(["B04", "B08", *INDEX_SQL])), "refl_wide")
def optical_indices(spark, d):
    return rounded(_day(view(spark, d, "refl_wide")).select("x", "y", "t", "B04", "B08", *indices.optical(scale=10_000)))


_PB = {k: f"(CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, 0.0), 10000.0) / 10000 END)" for k, c in indices.PLANET.items()}
_PP = f"({_PB['N']} * (1 - {_PB['R']}) * ({_PB['N']} - {_PB['R']}))"
_PLANET = {
    "NDVI": _nd(_PB["N"], _PB["R"]), "AVI": f"CASE WHEN {_PP} >= 0 THEN pow({_PP}, 1.0 / 3) END", "CIRE": f"{_PB['N']} / nullif({_PB['RE1']}, 0) - 1",
    "NIRv": f"({_nd(_PB['N'], _PB['R'])}) * {_PB['N']}", "NDWI": _nd(_PB["G"], _PB["N"]),
}


@query("planet_indices", rounds(f"SELECT x, y, {DAY}, {', '.join(f'{e} AS {n}' for n, e in _PLANET.items())} FROM refl_wide", " ".join(_PLANET)), "refl_wide")
def planet_indices(spark, d):
    return rounded(_day(cube.planet_indices(view(spark, d, "refl_wide"))))


@query("radar_indices", rounds(f"SELECT x, y, {DAY}, VV, VH, 4 * VH / nullif(VV + VH, 0) AS RVI, VH - VV AS VHVVD, VH / nullif(VV, 0) AS VHVVR FROM refl_wide", "VV VH RVI VHVVD VHVVR"), "refl_wide")
def radar_indices(spark, d):
    return rounded(_day(view(spark, d, "refl_wide")).select("x", "y", "t", "VV", "VH", *indices.radar()))


@query("drop_if_exists", "SELECT point_id, lon, lat FROM ref_points", "ref_points")
def drop_if_exists(spark, d):
    return view(spark, d, "ref_points").drop("label", "easting", "northing", "zone_number", "zone_letter", "not_there")


@query("reorder_columns", "SELECT label, point_id, lon, lat FROM ref_points", "ref_points")
def reorder_columns(spark, d):
    p = view(spark, d, "ref_points").select("point_id", "lon", "lat", "label")
    return p.select("label", *[c for c in p.columns if c != "label"])


@query("make_point", "SELECT point_id, printf('POINT (%.2f %.2f)', lon, lat) AS wkt FROM ref_points", "ref_points")
def make_point(spark, d):
    return view(spark, d, "ref_points").select("point_id", F.format_string("POINT (%.2f %.2f)", "lon", "lat").alias("wkt"))


@query("bbox_centroid", "SELECT aoi_id, (west + east) / 2 AS cx, (south + north) / 2 AS cy FROM aoi_boxes", "aoi_boxes")
def bbox_centroid(spark, d):
    return view(spark, d, "aoi_boxes").select("aoi_id", ((F.col("west") + F.col("east")) / 2).alias("cx"), ((F.col("south") + F.col("north")) / 2).alias("cy"))


@query("row_count_check", "SELECT (SELECT count(*) FROM static_cube) AS n_left, (SELECT count(*) FROM scl_raster) AS n_right, (SELECT count(*) FROM static_cube) = (SELECT count(*) FROM scl_raster) AS equal", "static_cube scl_raster")
def row_count_check(spark, d):
    from pixelloom.operators.joins import same_count

    return same_count(view(spark, d, "static_cube"), view(spark, d, "scl_raster"))


# Masks and neighbourhoods. Oracles compare every pair of pixels.
_BAD = "bad AS (SELECT x, y, scl IN (0, 1, 3, 8, 9, 10, 11) AS f FROM scl_raster)"


def _bad(spark, d):
    return view(spark, d, "scl_raster").select("x", "y", pixel.scl_bad(F.col("scl")).alias("f"))


def _disk(source: str, r: int) -> str:
    return f"SELECT a.x, a.y, coalesce(bool_or(b.f), FALSE) AS f FROM {source} a LEFT JOIN {source} b ON b.f AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {r * r} GROUP BY a.x, a.y"


def _erode(source: str, r: int) -> str:
    return f"SELECT a.x, a.y, NOT coalesce(bool_or(NOT b.f), FALSE) AS f FROM {source} a LEFT JOIN {source} b ON NOT b.f AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {r * r} GROUP BY a.x, a.y"


def _square(source: str, k: int) -> str:
    return f"SELECT a.x, a.y, bool_or(b.f) AS f FROM {source} a JOIN {source} b ON abs(a.x - b.x) <= {k // 2} AND abs(a.y - b.y) <= {k // 2} GROUP BY a.x, a.y"


@query("convolve_disk", f"WITH {_BAD} SELECT a.x, a.y, count(b.x) AS n FROM bad a LEFT JOIN bad b ON b.f AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 9 GROUP BY a.x, a.y", "scl_raster")
def convolve_disk(spark, d):
    return spatial.convolve_disk(_bad(spark, d), "f", 3)


@query("dilate_disk", f"WITH {_BAD} {_disk('bad', 2)}", "scl_raster")
def dilate_disk(spark, d):
    return spatial.dilate_disk(_bad(spark, d), "f", 2)


@query("erode_disk", f"WITH {_BAD} {_erode('bad', 1)}", "scl_raster")
def erode_disk(spark, d):
    return spatial.erode_disk(_bad(spark, d), "f", 1)


@query("dilate_square", f"WITH cloud AS (SELECT x, y, scl = 9 AS f FROM scl_raster) {_square('cloud', 5)}", "scl_raster")
def dilate_square(spark, d):
    return spatial.dilate_square(view(spark, d, "scl_raster").select("x", "y", (F.col("scl") == 9).alias("f")), "f", 5)


@query("dilate_square_sparse", f"WITH cloud AS (SELECT x, y, scl = 9 AS f FROM scl_raster WHERE scl % 3 = 0) {_square('cloud', 5)}", "scl_raster")
def dilate_square_sparse(spark, d):
    """A table that lacks most pixels: those between a flagged pixel and another don't matter."""
    return spatial.dilate_square(view(spark, d, "scl_raster").where("scl % 3 = 0").select("x", "y", (F.col("scl") == 9).alias("f")), "f", 5)


@query("satio_scl_mask", f"WITH {_BAD}, e AS ({_erode('bad', 1)}), m AS ({_disk('e', 3)}) SELECT x, y, f AS mask FROM m", "scl_raster")
def satio_scl_mask(spark, d):
    return spatial.satio_mask(view(spark, d, "scl_raster"), erode=1, dilate=3)


@query("scl_dilation_mask", f"WITH o AS (SELECT x, y, scl NOT IN (2, 4, 5, 6, 7) AS f FROM scl_raster), c AS (SELECT x, y, scl IN (3, 8, 9, 10, 11) AS f FROM scl_raster), oe AS ({_erode('o', 1)}), ce AS ({_erode('c', 1)}), od AS ({_square('oe', 3)}), cd AS ({_square('ce', 7)}) SELECT od.x, od.y, od.f OR cd.f AS mask FROM od JOIN cd USING (x, y)", "scl_raster")
def scl_dilation_mask(spark, d):
    return spatial.two_mask(view(spark, d, "scl_raster"), "scl", pixel.SCL_KEEP, pixel.SCL_CLOUDY, (3, 7), 1)


_HOLES = "h AS (SELECT x, y, CASE WHEN (x + y) % 6 <> 0 THEN scl END AS scl FROM scl_raster)"


@query("scl_dilation_mask_nulls", f"WITH {_HOLES}, o AS (SELECT x, y, coalesce(scl NOT IN (2, 4, 5, 6, 7), FALSE) AS f FROM h), c AS (SELECT x, y, coalesce(scl IN (3, 8, 9, 10, 11), FALSE) AS f FROM h), oe AS ({_erode('o', 1)}), ce AS ({_erode('c', 1)}), od AS ({_square('oe', 3)}), cd AS ({_square('ce', 7)}) SELECT od.x, od.y, od.f OR cd.f AS mask FROM od JOIN cd USING (x, y)", "scl_raster")
def scl_dilation_mask_nulls(spark, d):
    """Pixels without a class mask nothing."""
    cells = view(spark, d, "scl_raster").withColumn("scl", F.when((F.col("x") + F.col("y")) % 6 != 0, F.col("scl")))
    return spatial.two_mask(cells, "scl", pixel.SCL_KEEP, pixel.SCL_CLOUDY, (3, 7), 1)


_CLASS = f"k AS (SELECT x, y, CASE WHEN cloud = 1 THEN 7 WHEN heavy = 1 THEN 6 WHEN light = 1 THEN 5 WHEN shadow = 1 THEN 4 WHEN snow = 1 THEN 3 WHEN conf < 0.8 THEN 2 ELSE 1 END AS c FROM (SELECT x, y, {_UDM} FROM scl_raster))"


@query("udm2_dilation_mask", f"WITH {_CLASS}, o AS (SELECT x, y, c <> 1 AS f FROM k), c2 AS (SELECT x, y, c >= 2 AS f FROM k), oe AS ({_erode('o', 1)}), ce AS ({_erode('c2', 1)}), od AS ({_square('oe', 3)}), cd AS ({_square('ce', 5)}) SELECT od.x, od.y, od.f OR cd.f AS mask FROM od JOIN cd USING (x, y)", "scl_raster")
def udm2_dilation_mask(spark, d):
    classes = _udm(spark, d).select("x", "y", pixel.classify_udm2(*map(F.col, _UDM_ARGS)).alias("c"))
    return spatial.two_mask(classes, "c", (1,), (2, 3, 4, 5, 6, 7), (3, 5), 1)


@query("udm2_erode_dilate_mask", f"WITH v AS (SELECT x, y, NOT (clear = 1 AND snow = 0 AND shadow = 0 AND light = 0 AND heavy = 0 AND cloud = 0) AS f FROM (SELECT x, y, {_UDM} FROM scl_raster)), e AS ({_erode('v', 1)}), m AS ({_disk('e', 2)}) SELECT x, y, f AS mask FROM m", "scl_raster")
def udm2_erode_dilate_mask(spark, d):
    args = [F.col(c) for c in _UDM_ARGS[:-1]]
    bad = _udm(spark, d).select("x", "y", (~pixel.udm2_valid(*args, F.lit(1.0))).alias("mask"))
    return spatial.dilate_disk(spatial.erode_disk(bad, "mask", 1), "mask", 2)


@query("apply_mask", f"SELECT r.x, r.y, {DAY}, CASE WHEN s.scl IN (8, 9, 10) THEN NULL ELSE B04 END AS B04 FROM refl_wide r LEFT JOIN scl_raster s USING (x, y)", "refl_wide scl_raster")
def apply_mask(spark, d):
    mask = view(spark, d, "scl_raster").select("x", "y", F.col("scl").isin(8, 9, 10).alias("mask"))
    return spatial.apply_mask(_day(view(spark, d, "refl_wide")).select("x", "y", "t", "B04"), mask, ["B04"])


@query("mask_as_band", "SELECT t.x, t.y, dem, scl IN (8, 9, 10) AS \"S2-CLOUD-MASK\" FROM static_cube t LEFT JOIN scl_raster s USING (x, y)", "static_cube scl_raster")
def mask_as_band(spark, d):
    mask = view(spark, d, "scl_raster").select("x", "y", F.col("scl").isin(8, 9, 10).alias("mask"))
    return spatial.mask_as_band(view(spark, d, "static_cube").select("x", "y", "dem"), mask)


@query("resample_near", "SELECT CAST(floor(x / 2.0) AS INT) AS x, CAST(floor(y / 2.0) AS INT) AS y, arg_min(dem, y * 1000 + x) AS dem FROM static_cube GROUP BY 1, 2", "static_cube")
def resample_near(spark, d):
    return spatial.resample_near(view(spark, d, "static_cube"), ["dem"], 2)


@query("resample_bilinear", rounds("""SELECT f.x, f.y, sum(w * dem) / nullif(sum(w), 0) AS dem FROM
 (SELECT x, y, x0 + i AS sx, y0 + j AS sy, (CASE i WHEN 1 THEN px - x0 ELSE 1 - px + x0 END) * (CASE j WHEN 1 THEN py - y0 ELSE 1 - py + y0 END) AS w FROM
  (SELECT *, CAST(floor(px) AS INT) AS x0, CAST(floor(py) AS INT) AS y0 FROM (SELECT s.x * 2 + i AS x, s.y * 2 + j AS y, (s.x * 2 + i + 0.5) / 2 - 0.5 AS px, (s.y * 2 + j + 0.5) / 2 - 0.5 AS py FROM static_cube s, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j))), (VALUES (0), (1)) c(i), (VALUES (0), (1)) e(j)) f
 JOIN static_cube s ON s.x = f.sx AND s.y = f.sy GROUP BY f.x, f.y""", "dem"), "static_cube")
def resample_bilinear(spark, d):
    return rounded(spatial.resample_bilinear(view(spark, d, "static_cube"), ["dem"], 2))


@query("chunk_with_halo", """SELECT x, y, cx AS chunk_x, cy AS chunk_y, floor(x / 16.0) = cx AND floor(y / 16.0) = cy AS is_core FROM scl_raster, range(-1, 6) a(cx), range(-1, 6) b(cy)
 WHERE x BETWEEN cx * 16 - 4 AND cx * 16 + 19 AND y BETWEEN cy * 16 - 4 AND cy * 16 + 19""", "scl_raster")
def chunk_with_halo(spark, d):
    return spatial.with_halo(view(spark, d, "scl_raster"), 16, 4).select("x", "y", F.col("chunk_x").cast("long").alias("chunk_x"), F.col("chunk_y").cast("long").alias("chunk_y"), "is_core")
