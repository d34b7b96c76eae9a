"""Queries that resample to another projection; their oracles write the series of both projections in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelloom.operators import warp
from pixelloom.plans import cube
from pixelloom.plans.queries_cube import DN_SQL, PERIOD_SQL
from pixelloom.plans.registry import query, rounded, rounds, with_rounds
from pixelloom.plans.views import view

UTM31, UTM32 = warp.Grid(32631, 690_000.0, 5_700_000.0, 1000.0), warp.Grid(32632, 270_000.0, 5_700_000.0, 1000.0)
EUROPE, DEGREES = warp.Grid(3035, 3_990_000.0, 3_180_000.0, 700.0), warp.Grid(4326, 5.6, 51.6, 0.01)

# Pixel centres of the target around the source as lon and lat in radians (l, f), from EPSG:3035 or in degrees.
_AROUND = "tg AS (SELECT CAST(tx AS INT) AS tx, CAST(ty AS INT) AS ty FROM (SELECT unnest(range(-40, 140)) AS tx), (SELECT unnest(range(-60, CAST(max(y) * 1.6 AS INT) + 100)) AS ty FROM static_cube))"
_FROM_EUROPE = f"""{_AROUND},
c0 AS (SELECT sqrt(2 / 298.257222101 - 1 / 298.257222101 ** 2) AS e, sin(radians(52)) AS s0, cos(radians(52)) AS c0),
c1 AS (SELECT *, (1 - e * e) * (s0 / (1 - e * e * s0 * s0) - ln((1 - e * s0) / (1 + e * s0)) / (2 * e)) AS qc, (1 - e * e) * (1 / (1 - e * e) - ln((1 - e) / (1 + e)) / (2 * e)) AS qp FROM c0),
c2 AS (SELECT *, asin(qc / qp) AS b0, 6378137 * sqrt(qp / 2) AS r FROM c1),
c3 AS (SELECT *, 6378137 * c0 / sqrt(1 - e * e * s0 * s0) / (r * cos(b0)) AS d FROM c2),
g0 AS (SELECT tx, ty, e, b0, r, ({EUROPE.west} + (tx + 0.5) * {EUROPE.size} - 4321000) / d AS px, ({EUROPE.north} - (ty + 0.5) * {EUROPE.size} - 3210000) * d AS py FROM tg, c3),
g1 AS (SELECT *, sqrt(px * px + py * py) AS rho, 2 * asin(sqrt(px * px + py * py) / (2 * r)) AS ce FROM g0),
g2 AS (SELECT *, asin(cos(ce) * sin(b0) + py * sin(ce) * cos(b0) / rho) AS b FROM g1),
ll AS (SELECT tx, ty, radians(10) + atan2(px * sin(ce), rho * cos(b0) * cos(ce) - py * sin(b0) * sin(ce)) AS l,
 b + (e ** 2 / 3 + 31 * e ** 4 / 180 + 517 * e ** 6 / 5040) * sin(2 * b) + (23 * e ** 4 / 360 + 251 * e ** 6 / 3780) * sin(4 * b) + 761 * e ** 6 / 45360 * sin(6 * b) AS f FROM g2)"""
_FROM_DEGREES = f"{_AROUND}, ll AS (SELECT tx, ty, radians({DEGREES.west} + (tx + 0.5) * {DEGREES.size}) AS l, radians({DEGREES.north} - (ty + 0.5) * {DEGREES.size}) AS f FROM tg)"


def _to_utm(name: str, grid: warp.Grid) -> str:
    """CTEs that end in ``name``: (tx, ty, u, v), the place of each target centre in pixels of a UTM grid."""
    mid = (grid.epsg % 100) * 6 - 183
    return f"""{name}k AS (SELECT 1 / 298.257223563 / (2 - 1 / 298.257223563) AS n),
{name}0 AS (SELECT tx, ty, n, 6378137 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) * 0.9996 AS r, l - radians({mid}) AS l, sinh(atanh(sin(f)) - 2 * sqrt(n) / (1 + n) * atanh(2 * sqrt(n) / (1 + n) * sin(f))) AS t FROM ll, {name}k),
{name}1 AS (SELECT *, atan2(t, cos(l)) AS x, atanh(sin(l) / sqrt(1 + t * t)) AS y, n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180 AS a1, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440 AS a2, 61 * n ** 3 / 240 - 103 * n ** 4 / 140 AS a3, 49561 * n ** 4 / 161280 AS a4 FROM {name}0),
{name} AS (SELECT tx, ty, (500000 + r * (y + a1 * cos(2 * x) * sinh(2 * y) + a2 * cos(4 * x) * sinh(4 * y) + a3 * cos(6 * x) * sinh(6 * y) + a4 * cos(8 * x) * sinh(8 * y)) - {grid.west}) / {grid.size} AS u,
 ({grid.north} - r * (x + a1 * sin(2 * x) * cosh(2 * y) + a2 * sin(4 * x) * cosh(4 * y) + a3 * sin(6 * x) * cosh(6 * y) + a4 * sin(8 * x) * cosh(8 * y))) / {grid.size} AS v FROM {name}1)"""


def _bilinear_sql(places: str, bands: str, source: str = "static_cube") -> str:
    means = ", ".join(f"sum(w * {b}) / nullif(sum(CASE WHEN {b} IS NOT NULL THEN w END), 0) AS {b}" for b in bands.split())
    taps = f"SELECT tx, ty, CAST(floor(u - 0.5) AS INT) + i AS x, CAST(floor(v - 0.5) AS INT) + j AS y, (CASE i WHEN 1 THEN u - 0.5 - floor(u - 0.5) ELSE floor(u - 0.5) + 1.5 - u END) * (CASE j WHEN 1 THEN v - 0.5 - floor(v - 0.5) ELSE floor(v - 0.5) + 1.5 - v END) AS w FROM {places}, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)"
    return f"SELECT tx AS x, ty AS y, {means} FROM ({taps}) JOIN {source} USING (x, y) WHERE w > 1e-6 GROUP BY tx, ty"


def _source(spark, d):
    return view(spark, d, "static_cube").withColumn("soc", F.when(F.col("soc") > 5, F.col("soc")))


_SOURCE = "sc AS (SELECT x, y, dem, CASE WHEN soc > 5 THEN soc END AS soc FROM static_cube)"


@query("warp_bilinear", f"WITH {_FROM_EUROPE}, {_to_utm('p', UTM31)}, {_SOURCE} {rounds(_bilinear_sql('p', 'dem soc', 'sc'), 'dem soc')}", "static_cube")
def warp_bilinear(spark, d):
    """UTM 31N at 1000 m to EPSG:3035 at 700 m, with null values."""
    return rounded(warp.warp(_source(spark, d), ["dem", "soc"], UTM31, EUROPE, "bilinear", (), block=16))


@query("warp_near", f"WITH {_FROM_DEGREES}, {_to_utm('p', UTM31)} SELECT tx AS x, ty AS y, dem, soc FROM p JOIN static_cube s ON s.x = CAST(floor(u) AS INT) AND s.y = CAST(floor(v) AS INT)", "static_cube")
def warp_near(spark, d):
    """UTM 31N to degrees."""
    return warp.warp(view(spark, d, "static_cube"), ["dem", "soc"], UTM31, DEGREES, "near", (), block=16)


@query("warp_two_zones", f"""WITH {_FROM_EUROPE}, {_to_utm('p', UTM31)}, {_to_utm('q', UTM32)},
a AS (SELECT tx, ty, dem FROM p JOIN static_cube s ON s.x = CAST(floor(u) AS INT) AND s.y = CAST(floor(v) AS INT)),
b AS (SELECT tx, ty, -dem AS dem FROM q JOIN static_cube s ON s.x = CAST(floor(u) AS INT) AND s.y = CAST(floor(v) AS INT))
SELECT coalesce(a.tx, b.tx) AS x, coalesce(a.ty, b.ty) AS y, coalesce(a.dem, b.dem) AS dem FROM a FULL JOIN b ON a.tx = b.tx AND a.ty = b.ty""", "static_cube")
def warp_two_zones(spark, d):
    """Rasters of two UTM zones that overlap, on one grid of EPSG:3035; the western comes first."""
    west, east = view(spark, d, "static_cube"), view(spark, d, "static_cube").withColumn("dem", -F.col("dem"))
    layers = [warp.warp(c, ["dem"], g, EUROPE, "near", (), block=16) for c, g in ((west, UTM31), (east, UTM32))]
    return warp.mosaic(layers, ["dem"], ())


_CUSTOM = cube.options("raw", masking="classes", ts_interval="month", source_grid=UTM31, target_grid=EUROPE)
_NEAR = f"{_FROM_EUROPE}, {_to_utm('p', UTM31)}, n AS (SELECT tx, ty, CAST(floor(u) AS INT) AS x, CAST(floor(v) AS INT) AS y FROM p)"
# One row for each pixel and time, the least by its bands.
_ONE = "o AS (SELECT x, y, t, min({v}) AS v FROM refl_wide {w} GROUP BY x, y, t)"


@query("s1_cube_custom_crs", with_rounds(f"{_NEAR}, {_ONE.format(v='struct_pack(VV, VH)', w='')}", f"SELECT tx AS x, ty AS y, {PERIOD_SQL['month']} AS t, {DN_SQL.format(v='avg(VV)')} AS VV, {DN_SQL.format(v='avg(VH)')} AS VH FROM n JOIN (SELECT x, y, t, v.VV AS VV, v.VH AS VH FROM o) USING (x, y) GROUP BY ALL", "VV VH", 3), "refl_wide static_cube")
def s1_cube_custom_crs(spark, d):
    """Backscatter on the grid of another projection."""
    return rounded(cube.s1_cube(view(spark, d, "refl_wide"), _CUSTOM), 3)


@query("s2_cube_custom_crs", with_rounds(f"{_NEAR}, {_ONE.format(v='struct_pack(scl, B04)', w='WHERE cloud_cover <= 95')}", f"SELECT tx AS x, ty AS y, {PERIOD_SQL['month']} AS t, median(CASE WHEN v.scl IN (0, 1, 3, 8, 9, 10, 11) THEN NULL ELSE v.B04 END) AS B04 FROM n JOIN o USING (x, y) GROUP BY ALL", "B04", 3), "refl_wide static_cube")
def s2_cube_custom_crs(spark, d):
    """Reflectances with their scene classes on the grid of another projection, masked there."""
    return rounded(cube.s2_cube(view(spark, d, "refl_wide"), _CUSTOM, ("B04",)), 3)
