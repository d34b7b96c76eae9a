"""Queries over polygons with holes and parts, which come from GeoJSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelloom.operators import grids, outlines, polygons
from pixelloom.plans.registry import query
from pixelloom.plans.views import view

# Each area: a frame whose hole leaves its outer fifth, and a second part, a box to the east of it.
_PARTS = """aoi AS (SELECT aoi_id, aoi_name, west AS w, south AS s, west + (east - west) * 4 AS e, south + (north - south) * 4 AS n,
 west + (east - west) * 0.8 AS hw, south + (north - south) * 0.8 AS hs, west + (east - west) * 3.2 AS he, south + (north - south) * 3.2 AS hn,
 west + (east - west) * 5 AS pw, west + (east - west) * 6 AS pe FROM aoi_boxes)"""
_BIG = "g AS (SELECT 'E' || lpad(CAST(e AS VARCHAR), 2, '0') || 'N' || lpad(CAST(n AS VARCHAR), 2, '0') AS name, e * 100000 AS west, n * 100000 AS south, (e + 1) * 100000 AS east, (n + 1) * 100000 AS north FROM range(9, 81) a(e), range(8, 76) b(n))"
_HIT = """(t.west <= a.e AND t.east >= a.w AND t.south <= a.n AND t.north >= a.s AND NOT (t.west > a.hw AND t.east < a.he AND t.south > a.hs AND t.north < a.hn)
 OR t.west <= a.pe AND t.east >= a.pw AND t.south <= a.n AND t.north >= a.s)"""


def _geojson(spark, d):
    """(aoi_id, aoi_name, kind, coordinates): the areas as GeoJSON multipolygons."""
    a = view(spark, d, "aoi_boxes")
    w, s, dx, dy = F.col("west"), F.col("south"), F.col("east") - F.col("west"), F.col("north") - F.col("south")
    at = lambda i, j: F.array(w + dx * i, s + dy * j)
    ring = lambda x0, y0, x1, y1: F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0))
    parts = F.array(F.array(ring(0, 0, 4, 4), ring(0.8, 0.8, 3.2, 3.2)), F.array(ring(5, 0, 6, 4)))
    return a.select("aoi_id", "aoi_name", F.lit("MultiPolygon").alias("kind"), F.to_json(parts).alias("coordinates"))


def _covered(spark, d, **more):
    areas = _geojson(spark, d).withColumn("rings", polygons.rings_of(F.col("kind"), F.col("coordinates")))
    return areas, polygons.cover(areas, "aoi_id", "rings", 50_000, levels=4, depth=6, **more)


def _tiles(spark, d):
    return grids.laea_100k(spark).join(view(spark, d, "laea_tiles"), "name", "left_semi")


@query("aoi_multipolygon_tiles", f"WITH {_BIG}, {_PARTS} SELECT t.* FROM g t JOIN laea_tiles USING (name) WHERE EXISTS (SELECT 1 FROM aoi a WHERE {_HIT})", "aoi_boxes laea_tiles")
def aoi_multipolygon_tiles(spark, d):
    """Tiles that meet any area with holes and parts: a tile inside a hole doesn't."""
    return polygons.tiles_of_polygons(_tiles(spark, d), "name", _covered(spark, d)[1])


@query("aoi_multipolygon_left_join", f"WITH {_BIG}, {_PARTS} SELECT t.name, a.aoi_id, a.aoi_name FROM (SELECT g.* FROM g JOIN laea_tiles USING (name)) t LEFT JOIN aoi a ON {_HIT}", "aoi_boxes laea_tiles")
def aoi_multipolygon_left_join(spark, d):
    areas, covering = _covered(spark, d)
    return polygons.polygon_left_join(_tiles(spark, d), "name", areas, covering, ["aoi_name"]).select("name", "aoi_id", "aoi_name")


@query("grid_filter_land_polygons", f"WITH {_BIG}, {_PARTS} SELECT name FROM g t WHERE EXISTS (SELECT 1 FROM aoi a WHERE {_HIT})", "aoi_boxes")
def grid_filter_land_polygons(spark, d):
    """The whole 100 km grid, cut to land with lakes and islands."""
    return polygons.tiles_of_polygons(grids.laea_100k(spark), "name", _covered(spark, d)[1]).select("name")


_PLACES = "p AS (SELECT c_custkey AS point_id, 900000.5 + (c_custkey * 7919) % 7000000 AS x, 800000.5 + (c_custkey * 104729) % 6600000 AS y FROM customer)"


@query("points_in_multipolygons", f"WITH {_PLACES}, {_PARTS} SELECT point_id, aoi_id FROM p JOIN aoi a ON x BETWEEN w AND e AND y BETWEEN s AND n AND NOT (x BETWEEN hw AND he AND y BETWEEN hs AND hn) OR x BETWEEN pw AND pe AND y BETWEEN s AND n", "aoi_boxes")
def points_in_multipolygons(spark, d):
    places = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey AS point_id", "900000.5D + (c_custkey * 7919) % 7000000 AS x", "800000.5D + (c_custkey * 104729) % 6600000 AS y")
    return polygons.points_inside(places, "point_id", _covered(spark, d, few=0)[1])


# Independent of rings: sides with one cell, and the cells around each corner point (Euler's number from quads of cells).
_OUTLINE = """c AS (SELECT DISTINCT CASE WHEN zone_letter >= 'N' THEN 'north' ELSE 'south' END AS half, CAST(floor(easting / 100000) AS BIGINT) AS i, CAST(floor(northing / 100000) AS BIGINT) AS j FROM ref_points),
 sides AS (SELECT half, count(*) AS n FROM (SELECT half, x, y, flat FROM (SELECT half, i AS x, j AS y, 1 AS flat FROM c UNION ALL SELECT half, i, j + 1, 1 FROM c UNION ALL SELECT half, i, j, 0 FROM c UNION ALL SELECT half, i + 1, j, 0 FROM c) GROUP BY ALL HAVING count(*) = 1) GROUP BY half),
 quads AS (SELECT half, x, y, sum(q) AS q FROM (SELECT half, i AS x, j AS y, 1 AS q FROM c UNION ALL SELECT half, i + 1, j, 2 FROM c UNION ALL SELECT half, i, j + 1, 4 FROM c UNION ALL SELECT half, i + 1, j + 1, 8 FROM c) GROUP BY half, x, y),
 turns AS (SELECT half, count(*) FILTER (q IN (1, 2, 4, 8)) AS one, count(*) FILTER (q IN (7, 11, 13, 14)) AS three, count(*) FILTER (q IN (6, 9)) AS two FROM quads GROUP BY half),
 cells AS (SELECT half, count(*) AS n FROM c GROUP BY half)"""


@query("dissolve_outlines", f"WITH {_OUTLINE} SELECT half, CAST((one - three + 2 * two) // 4 AS BIGINT) AS parts_less_holes, cells.n * 10000 AS area_km2, sides.n * 100 AS length_km, one + three + 2 * two AS corners FROM turns JOIN cells USING (half) JOIN sides USING (half)", "ref_points")
def dissolve_outlines(spark, d):
    w, s = F.floor(F.col("easting") / 100_000) * 100_000, F.floor(F.col("northing") / 100_000) * 100_000
    squares = view(spark, d, "ref_points").select("zone_letter", w.alias("west"), s.alias("south"), (w + 100_000).alias("east"), (s + 100_000).alias("north"))
    half = F.when(F.col("zone_letter") >= "N", "north").otherwise("south")  # zones are laid over each other
    rings = outlines.outlines(squares, half, "half", 100_000)
    parts, area, length, corners = outlines.measures(F.col("rings"))
    return rings.select("half", parts.cast("long").alias("parts_less_holes"), F.round(area / 1e6).cast("long").alias("area_km2"), F.round(length / 1000).cast("long").alias("length_km"), corners.cast("long").alias("corners"))
