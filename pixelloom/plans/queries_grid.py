"""Queries of identifiers, grids, projections and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelloom.functions import crs, grid
from pixelloom.operators import grids, joins
from pixelloom.plans.registry import query, rounded, with_rounds
from pixelloom.plans.views import view

_LETTERS = "'CDEFGHJKLMNPQRSTUVWXX'"
_COL = "substr(CASE (zone_number - 1) % 3 WHEN 0 THEN 'ABCDEFGH' WHEN 1 THEN 'JKLMNPQR' ELSE 'STUVWXYZ' END, CAST(floor(easting / 100000) AS INT), 1)"
_ROW = "substr(CASE (zone_number - 1) % 2 WHEN 0 THEN 'ABCDEFGHJKLMNPQRSTUV' ELSE 'FGHJKLMNPQRSTUVABCDE' END, CAST(floor(northing / 100000) AS INT) % 20 + 1, 1)"
_GREEK = "substr(CASE WHEN zone_letter >= 'N' THEN 'λπστφ' ELSE 'αßΓδε' END, CAST(floor(northing / 2000000) AS INT) + 1, 1)"
_ZONE = "lpad(CAST(zone_number AS VARCHAR), 2, '0')"
_G100 = f"{_ZONE} || {_GREEK} || {_COL} || {_ROW}"
_G20 = f"{_G100} || CAST(CAST(floor((easting % 100000) / 20000) AS INT) AS VARCHAR) || CAST(CAST(floor((northing % 100000) / 20000) AS INT) AS VARCHAR)"



def E():
    return F.col("easting")


def N():
    return F.col("northing")


def Z():
    return F.col("zone_number")


def NORTH():
    return F.col("zone_letter") >= "N"


def _points(spark, d):
    return view(spark, d, "ref_points")


@query("utm_zone_letter", f"SELECT point_id, CASE WHEN lat BETWEEN -80 AND 84 THEN substr({_LETTERS}, CAST(floor((lat + 80) / 8) AS INT) + 1, 1) END AS letter FROM ref_points", "ref_points")
def utm_zone_letter(spark, d):
    return _points(spark, d).select("point_id", grid.zone_letter(F.col("lat")).alias("letter"))


@query("utm_zone_number", """SELECT point_id, CASE WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32 WHEN lat >= 72 AND lat <= 84 AND lon >= 0 AND lon < 42 THEN
 CASE WHEN lon < 9 THEN 31 WHEN lon < 21 THEN 33 WHEN lon < 33 THEN 35 ELSE 37 END ELSE CAST(floor((lon + 180) / 6) AS INT) % 60 + 1 END AS zone FROM ref_points""", "ref_points")
def utm_zone_number(spark, d):
    return _points(spark, d).select("point_id", grid.zone_number(F.col("lon"), F.col("lat")).alias("zone"))


@query("utm_epsg", "SELECT point_id, CASE WHEN zone_letter >= 'N' THEN 32600 ELSE 32700 END + zone_number AS epsg FROM ref_points", "ref_points")
def utm_epsg(spark, d):
    return _points(spark, d).select("point_id", grid.utm_epsg(Z(), NORTH()).alias("epsg"))


@query("mgrs_100k_letters", f"SELECT point_id, {_COL} || {_ROW} AS letters FROM ref_points", "ref_points")
def mgrs_100k_letters(spark, d):
    return _points(spark, d).select("point_id", grid.mgrs_100k(Z(), E(), N()).alias("letters"))


@query("mgrs_2mil_letter", f"SELECT point_id, {_GREEK} AS letter FROM ref_points", "ref_points")
def mgrs_2mil_letter(spark, d):
    return _points(spark, d).select("point_id", grid.greek_letter(N(), NORTH()).alias("letter"))


@query("mgrs_id", f"SELECT point_id, {_ZONE} || zone_letter || {_COL} || {_ROW} AS mgrs FROM ref_points", "ref_points")
def mgrs_id(spark, d):
    return _points(spark, d).select("point_id", grid.mgrs_id(Z(), F.col("zone_letter"), E(), N()).alias("mgrs"))


def _digits(v: str, unit: int, n: int) -> str:
    return f"lpad(CAST(CAST(floor(({v} % 100000) / {unit}) AS INT) AS VARCHAR), {n}, '0')"


for _name, _n in (("mgrs_id10", 4), ("mgrs_id1", 5)):

    @query(_name, f"SELECT point_id, {_ZONE} || zone_letter || {_COL} || {_ROW} || {_digits('easting', 10 ** (5 - _n), _n)} || {_digits('northing', 10 ** (5 - _n), _n)} AS mgrs FROM ref_points", "ref_points")
    def _mgrs(spark, d, n=_n):
        return _points(spark, d).select("point_id", grid.mgrs_metres(Z(), F.col("zone_letter"), E(), N(), n).alias("mgrs"))


@query("pixel_center", "SELECT point_id, floor(easting / 10) * 10 + 5 AS e, floor(-northing / 20) * 20 + 10 AS n FROM ref_points", "ref_points")
def pixel_center(spark, d):
    return _points(spark, d).select("point_id", grid.pixel_centre(E(), 10).alias("e"), grid.pixel_centre(-N(), 20).alias("n"))


@query("grid100id", f"SELECT point_id, {_G100} AS id FROM ref_points", "ref_points")
def grid100id(spark, d):
    return _points(spark, d).select("point_id", grid.grid100_id(Z(), NORTH(), E(), N()).alias("id"))


@query("grid20id", f"SELECT point_id, {_G20} AS id FROM ref_points", "ref_points")
def grid20id(spark, d):
    return _points(spark, d).select("point_id", grid.grid20_id(Z(), NORTH(), E(), N()).alias("id"))


@query("point_in_tile", f"SELECT id, count(*) AS n FROM (SELECT {_G20} AS id FROM ref_points) GROUP BY id", "ref_points")
def point_in_tile(spark, d):
    return _points(spark, d).groupBy(grid.grid20_id(Z(), NORTH(), E(), N()).alias("id")).agg(F.count("*").alias("n"))


@query("gridid_to_epsg", "SELECT point_id, CASE WHEN zone_letter >= 'N' THEN 32600 ELSE 32700 END + zone_number AS epsg FROM ref_points", "ref_points")
def gridid_to_epsg(spark, d):
    return _points(spark, d).select("point_id", grid.grid_epsg(grid.grid20_id(Z(), NORTH(), E(), N())).alias("epsg"))


@query("mgrsid_to_epsg", "SELECT point_id, CASE WHEN zone_letter >= 'N' THEN 32600 ELSE 32700 END + zone_number AS epsg FROM ref_points", "ref_points")
def mgrsid_to_epsg(spark, d):
    return _points(spark, d).select("point_id", grid.mgrs_epsg(grid.mgrs_id(Z(), F.col("zone_letter"), E(), N())).alias("epsg"))


@query("point_info")
def point_info(spark, d):
    return grids.point_info(_points(spark, d), ["point_id"])


@query("mgrs_center_ll")
def mgrs_center_ll(spark, d):
    lon, lat = crs.from_utm(grid.pixel_centre(E(), 10), grid.pixel_centre(N(), 10), Z(), NORTH())
    return _points(spark, d).select("point_id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


# Both projections once more, from their published series; e: eccentricity, b: authalic latitude.
_UTM_SQL = """k AS (SELECT 1 / 298.257223563 / (2 - 1 / 298.257223563) AS n),
u0 AS (SELECT point_id, lon, lat, n, 6378137 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) * 0.9996 AS r, 2 * sqrt(n) / (1 + n) AS h, radians(lat) AS f, radians(lon - (least(CAST(floor((lon + 180) / 6) AS INT), 59) * 6 - 177)) AS l FROM ref_points, k),
u1 AS (SELECT *, sinh(atanh(sin(f)) - h * atanh(h * sin(f))) AS t FROM u0),
u2 AS (SELECT *, atan2(t, cos(l)) AS x, atanh(sin(l) / sqrt(1 + t * t)) AS y, n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180 AS a1, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440 AS a2, 61 * n ** 3 / 240 - 103 * n ** 4 / 140 AS a3, 49561 * n ** 4 / 161280 AS a4 FROM u1),
utm AS (SELECT point_id, 500000 + r * (y + a1 * cos(2 * x) * sinh(2 * y) + a2 * cos(4 * x) * sinh(4 * y) + a3 * cos(6 * x) * sinh(6 * y) + a4 * cos(8 * x) * sinh(8 * y)) AS easting,
 CASE WHEN lat < 0 THEN 10000000 ELSE 0 END + r * (x + a1 * sin(2 * x) * cosh(2 * y) + a2 * sin(4 * x) * cosh(4 * y) + a3 * sin(6 * x) * cosh(6 * y) + a4 * sin(8 * x) * cosh(8 * y)) AS northing FROM u2)"""
_LAEA_SQL = """c AS (SELECT sqrt(2 / 298.257222101 - 1 / 298.257222101 ** 2) AS e),
q0 AS (SELECT point_id, radians(lon - 10) AS l, e, sin(radians(lat)) AS s, sin(radians(52)) AS s0, cos(radians(52)) AS c0 FROM ref_points, c),
q1 AS (SELECT *, (1 - e * e) * (s / (1 - e * e * s * s) - ln((1 - e * s) / (1 + e * s)) / (2 * e)) AS q, (1 - e * e) * (s0 / (1 - e * e * s0 * s0) - ln((1 - e * s0) / (1 + e * s0)) / (2 * e)) AS qc, (1 - e * e) * (1 / (1 - e * e) - ln((1 - e) / (1 + e)) / (2 * e)) AS qp FROM q0),
q2 AS (SELECT *, asin(q / qp) AS b, asin(qc / qp) AS b0, 6378137 * sqrt(qp / 2) AS r FROM q1),
q3 AS (SELECT *, 6378137 * c0 / sqrt(1 - e * e * s0 * s0) / (r * cos(b0)) AS d, r * sqrt(2 / (1 + sin(b0) * sin(b) + cos(b0) * cos(b) * cos(l))) AS g FROM q2),
laea AS (SELECT point_id, 4321000 + g * d * cos(b) * sin(l) AS x, 3210000 + g / d * (cos(b0) * sin(b) - sin(b0) * cos(b) * cos(l)) AS y FROM q3)"""


@query("project_points", with_rounds(f"{_UTM_SQL}, {_LAEA_SQL}", "SELECT point_id, utm.easting, utm.northing, CASE WHEN lat BETWEEN 20 AND 80 AND lon BETWEEN -60 AND 80 THEN x END AS x, CASE WHEN lat BETWEEN 20 AND 80 AND lon BETWEEN -60 AND 80 THEN y END AS y FROM utm JOIN laea USING (point_id) JOIN ref_points USING (point_id)", "easting northing x y", 2), "ref_points")
def project_points(spark, d):
    """Points in UTM (zones without the northern exceptions) and, around Europe, in EPSG:3035, against both series written in SQL."""
    lon, lat = F.col("lon"), F.col("lat")
    zone = F.least(F.floor((lon + 180) / 6), F.lit(59)).cast("int") + 1
    e, n = crs.to_utm(lon, lat, zone, lat >= 0)
    x, y = crs.to_laea(lon, lat)
    near = lat.between(20, 80) & lon.between(-60, 80)
    return rounded(_points(spark, d).select("point_id", e.alias("easting"), n.alias("northing"), F.when(near, x).alias("x"), F.when(near, y).alias("y")), 2)


@query("reproject_points", "SELECT point_id, TRUE AS utm_back, TRUE AS laea_back FROM ref_points", "ref_points")
def reproject_points(spark, d):
    """There and back on both projections: within about a millimetre of where it began; EPSG:3035 is tried around Europe."""
    lon, lat = F.col("lon"), F.col("lat")
    p = _points(spark, d).withColumn("z", grid.zone_number(lon, lat))
    e, n = crs.to_utm(lon, lat, F.col("z"), lat >= 0)
    x, y = crs.to_laea(lon, lat)
    p = p.select("point_id", "lon", "lat", "z", e.alias("e"), n.alias("n"), x.alias("x"), y.alias("y"))
    a, b = crs.from_utm(F.col("e"), F.col("n"), F.col("z"), lat >= 0), crs.from_laea(F.col("x"), F.col("y"))
    close = lambda q, e=1e-9: (F.abs(q[0] - lon) < e) & (F.abs(q[1] - lat) < e)
    near = lat.between(35, 70) & lon.between(-15, 40)
    return p.select("point_id", close(a).alias("utm_back"), (close(b, 1e-8) | ~near).alias("laea_back"))


for _size in (20, 50, 100):

    @query(f"laea_extent_{_size}", f"SELECT name, CAST(substr(name, 2, 2) AS BIGINT) * 100000 AS west, CAST(substr(name, 5, 2) AS BIGINT) * 100000 AS south, CAST(substr(name, 2, 2) AS BIGINT) * 100000 + {_size}000 AS east, CAST(substr(name, 5, 2) AS BIGINT) * 100000 + {_size}000 AS north FROM laea_tiles", "laea_tiles")
    def _extent(spark, d, size=_size):
        return view(spark, d, "laea_tiles").select("name", *[c.alias(n) for n, c in grid.laea_extent(F.col("name"), size).items()])


@query("bbox_area_km2", "SELECT aoi_id, (east - west) * (north - south) / 1e6 AS km2 FROM aoi_boxes", "aoi_boxes")
def bbox_area(spark, d):
    return view(spark, d, "aoi_boxes").select("aoi_id", crs.bbox_area_km2(*map(F.col, joins.BOX)).alias("km2"))


@query("reproject_bbox_ll")
def reproject_bbox_ll(spark, d):
    box = crs.reproject_bbox(*map(F.col, joins.BOX), buffer=0.003)
    return rounded(view(spark, d, "aoi_boxes").select("aoi_id", *[c.alias(n) for n, c in box.items()]), 6)


_BIG = "g AS (SELECT 'E' || lpad(CAST(e AS VARCHAR), 2, '0') || 'N' || lpad(CAST(n AS VARCHAR), 2, '0') AS name, e * 100000 AS west, n * 100000 AS south, (e + 1) * 100000 AS east, (n + 1) * 100000 AS north FROM range(9, 81) a(e), range(8, 76) b(n))"


def _used(spark, d):
    """The 100 km tiles whose names the data have."""
    return grids.laea_100k(spark).join(view(spark, d, "laea_tiles"), "name", "left_semi")


@query("grid_laea_100k", f"WITH {_BIG} SELECT g.* FROM g JOIN laea_tiles USING (name)", "laea_tiles")
def grid_laea_100k(spark, d):
    return _used(spark, d)


for _size in (50, 20):

    @query(f"grid_laea_{_size}k", f"""WITH {_BIG}, c AS (SELECT name AS parent, west + i * {_size}000 AS west, south + j * {_size}000 AS south FROM g JOIN laea_tiles USING (name), range({100 // _size}) a(i), range({100 // _size}) b(j))
SELECT 'E' || lpad(CAST(west // 10000 AS VARCHAR), 3, '0') || 'N' || lpad(CAST(south // 10000 AS VARCHAR), 3, '0') AS name, parent, west, south, west + {_size}000 AS east, south + {_size}000 AS north FROM c""", "laea_tiles")
    def _children(spark, d, size=_size):
        return grids.laea_children(_used(spark, d), size)


_MEET = "t.west <= a.east AND a.west <= t.east AND t.south <= a.north AND a.south <= t.north"


@query("grid_filter_land", f"WITH {_BIG} SELECT name FROM g t WHERE EXISTS (SELECT 1 FROM aoi_boxes a WHERE {_MEET})", "aoi_boxes")
def grid_filter_land(spark, d):
    return grids.laea_100k(spark).transform(lambda t: joins.tiles_of_aoi(t, "name", view(spark, d, "aoi_boxes"), "aoi_id", 200_000)).select("name")


@query("aoi_tile_semijoin", f"WITH {_BIG} SELECT t.* FROM g t WHERE name IN (SELECT name FROM laea_tiles) AND EXISTS (SELECT 1 FROM aoi_boxes a WHERE {_MEET})", "aoi_boxes laea_tiles")
def aoi_tile_semijoin(spark, d):
    return joins.tiles_of_aoi(_used(spark, d), "name", view(spark, d, "aoi_boxes"), "aoi_id", 200_000)


_LEFT = f"SELECT t.name, a.aoi_id, a.aoi_name FROM (SELECT g.* FROM g JOIN laea_tiles USING (name)) t LEFT JOIN aoi_boxes a ON {_MEET}"


@query("spatial_join_left", f"WITH {_BIG} {_LEFT}", "aoi_boxes laea_tiles")
def spatial_join_left(spark, d):
    return joins.spatial_left_join(_used(spark, d), "name", view(spark, d, "aoi_boxes"), "aoi_id", ["aoi_name"], 200_000).select("name", "aoi_id", "aoi_name")


@query("aoi_tiler", f"WITH {_BIG} SELECT t.name, a.aoi_id, a.aoi_name FROM (SELECT g.* FROM g JOIN laea_tiles USING (name)) t JOIN aoi_boxes a ON {_MEET}", "aoi_boxes laea_tiles")
def aoi_tiler(spark, d):
    aoi = view(spark, d, "aoi_boxes")
    tiles = joins.tiles_of_aoi(_used(spark, d), "name", aoi, "aoi_id", 200_000)
    return joins.spatial_left_join(tiles, "name", aoi, "aoi_id", ["aoi_name"], 200_000).select("name", "aoi_id", "aoi_name")


_TRIANGLE = f"""t AS (SELECT g.* FROM g JOIN laea_tiles USING (name)), a AS (SELECT *, (west + east) / 2 AS mid FROM aoi_boxes)
SELECT t.name, a.aoi_id FROM t JOIN a ON {_MEET}
 AND greatest((a.mid - a.east) * (t.south - a.south) - (a.north - a.south) * (t.west - a.east), (a.mid - a.east) * (t.north - a.south) - (a.north - a.south) * (t.west - a.east)) >= 0
 AND greatest((a.west - a.mid) * (t.south - a.north) - (a.south - a.north) * (t.east - a.mid), (a.west - a.mid) * (t.north - a.north) - (a.south - a.north) * (t.east - a.mid)) >= 0"""


@query("aoi_polygon_join", f"WITH {_BIG}, {_TRIANGLE}", "aoi_boxes laea_tiles")
def aoi_polygon_join(spark, d):
    """Tiles of triangles; the oracle looks for a line of a triangle's side that parts it from the tile."""
    mid = (F.col("west") + F.col("east")) / 2
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    ring = F.array(corner(F.col("west"), "south"), corner(F.col("east"), "south"), corner(mid, "north"), corner(F.col("west"), "south"))
    return joins.polygon_pairs(_used(spark, d), "name", view(spark, d, "aoi_boxes").select("aoi_id", ring.alias("ring")), "aoi_id", "ring", 200_000)


@query("bbox_prefilter_join", f"SELECT a.aoi_id AS left_id, t.aoi_id AS right_id FROM aoi_boxes a JOIN aoi_boxes t ON {_MEET}", "aoi_boxes")
def bbox_prefilter_join(spark, d):
    a = view(spark, d, "aoi_boxes")
    return joins.box_pairs(a.withColumnRenamed("aoi_id", "left_id"), "left_id", a.withColumnRenamed("aoi_id", "right_id"), "right_id", 200_000)


@query("read_grid_bbox", "SELECT aoi_id, aoi_name FROM aoi_boxes WHERE east >= 2000000 AND west <= 5000000 AND north >= 2000000 AND south <= 4000000", "aoi_boxes")
def read_grid_bbox(spark, d):
    from pixelloom.sources.files import read_grid

    return read_grid(view(spark, d, "aoi_boxes"), 2_000_000, 2_000_000, 5_000_000, 4_000_000).select("aoi_id", "aoi_name")


@query("grid_utm20_global", f"""WITH c AS (SELECT DISTINCT zone_number, zone_letter, floor(easting / 20000) * 20000 AS w, floor(northing / 20000) * 20000 AS s FROM ref_points),
p AS (SELECT zone_number, zone_letter, w, s, w + 10000 AS easting, s + 10000 AS northing FROM c)
SELECT {_G20} AS grid20id, CASE WHEN zone_letter >= 'N' THEN 32600 ELSE 32700 END + zone_number AS epsg, CAST(w AS BIGINT) AS west, CAST(s AS BIGINT) AS south, CAST(w + 20000 AS BIGINT) AS east, CAST(s + 20000 AS BIGINT) AS north FROM p""", "ref_points")
def grid_utm20_global(spark, d):
    return grids.utm_20k(_points(spark, d).withColumn("north", NORTH()))


_KIDS = f"{_BIG}, k AS (SELECT name AS parent, west + i * 20000 AS west, south + j * 20000 AS south, west + (i + 1) * 20000 AS east, south + (j + 1) * 20000 AS north FROM g JOIN laea_tiles USING (name), range(5) a(i), range(5) b(j))"


@query("dissolve_grid", f"WITH {_KIDS} SELECT parent AS id, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north, count(*) AS n_tiles FROM k GROUP BY parent", "laea_tiles")
def dissolve_grid(spark, d):
    kids = grids.laea_children(_used(spark, d), 20)
    return grids.dissolve(kids, grid.parent_100km(F.col("name")), "id")


_U = f"""u AS (SELECT DISTINCT {_G20} AS grid20id, floor(easting / 20000) * 20000 AS west, floor(northing / 20000) * 20000 AS south FROM ref_points)"""


@query("processing_grid", f"WITH {_U}, l AS (SELECT *, unnest([7, 5, 6]) AS n FROM u) SELECT substr(grid20id, 1, n) AS id, CASE n WHEN 7 THEN 'tile' WHEN 5 THEN 'grid100' ELSE 'strip' END AS level, CAST(min(west) AS BIGINT) AS west, CAST(min(south) AS BIGINT) AS south, CAST(max(west) + 20000 AS BIGINT) AS east, CAST(max(south) + 20000 AS BIGINT) AS north, count(*) AS n_tiles FROM l GROUP BY ALL", "ref_points")
def processing_grid(spark, d):
    return grids.processing_grid(grids.utm_20k(_points(spark, d).withColumn("north", NORTH())))


_META = f"{_KIDS}, m AS (SELECT parent, 'T' || CAST(west // 150000 AS VARCHAR) || ',T' || CAST(south // 150000 AS VARCHAR) AS tiles FROM k)"


@query("collect_tile_union", f"WITH {_META} SELECT parent AS id, string_agg(t, ',' ORDER BY t) AS tiles FROM (SELECT DISTINCT parent, unnest(string_split(tiles, ',')) AS t FROM m) GROUP BY parent", "laea_tiles")
def collect_tile_union(spark, d):
    kids = _kid_meta(spark, d)
    return grids.collect_tiles(kids, F.col("parent"), "id", "tiles")


def _kid_meta(spark, d):
    part = lambda c: F.concat(F.lit("T"), F.floor(F.col(c) / 150_000).cast("string"))
    return grids.laea_children(_used(spark, d), 20).withColumn("tiles", F.concat_ws(",", part("west"), part("south")))


@query("parent_tile_meta", f"WITH {_META} SELECT parent AS id, string_agg(t, ',' ORDER BY t) AS tiles FROM (SELECT DISTINCT parent, unnest(string_split(tiles, ',')) AS t FROM m) GROUP BY parent", "laea_tiles")
def parent_tile_meta(spark, d):
    return grids.collect_tiles(_kid_meta(spark, d), grid.parent_100km(F.col("name")), "id", "tiles")


@query("join_tile_meta", f"WITH {_BIG} SELECT name, g.west, g.south FROM laea_tiles LEFT JOIN g USING (name)", "laea_tiles")
def join_tile_meta(spark, d):
    return view(spark, d, "laea_tiles").join(grids.laea_100k(spark), "name", "left").select("name", "west", "south")


# Overlapping tiles of 110 km on a 100 km lattice, and cells of 60 km, made from the areas of interest.
_TILES = "tl AS (SELECT DISTINCT 'T' || lpad(CAST(i AS VARCHAR), 2, '0') || lpad(CAST(j AS VARCHAR), 2, '0') AS tile, i * 100000.0 AS west, j * 100000.0 AS south, i * 100000 + 110000.0 AS east, j * 100000 + 110000.0 AS north FROM (SELECT CAST(floor(west / 100000) AS BIGINT) + unnest([-1, 0, 1]) AS i, CAST(floor(south / 100000) AS BIGINT) AS j0 FROM aoi_boxes), LATERAL (SELECT unnest([j0 - 1, j0, j0 + 1]) AS j))"
_CELLS = "ce AS (SELECT CAST(aoi_id AS VARCHAR) AS name, west, south, west + 60000 AS east, south + 60000 AS north FROM aoi_boxes)"


def _s2_tiles(spark, d):
    a = view(spark, d, "aoi_boxes").select(F.floor(F.col("west") / 100_000).alias("i0"), F.floor(F.col("south") / 100_000).alias("j0"))
    a = a.withColumn("i", F.explode(F.sequence(F.col("i0") - 1, F.col("i0") + 1))).withColumn("j", F.explode(F.sequence(F.col("j0") - 1, F.col("j0") + 1)))
    two = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    w, s = F.col("i") * 100_000.0, F.col("j") * 100_000.0
    return a.select(F.concat(F.lit("T"), two("i"), two("j")).alias("tile"), w.alias("west"), s.alias("south"), (w + 110_000).alias("east"), (s + 110_000).alias("north")).distinct()


def _cells(spark, d):
    return view(spark, d, "aoi_boxes").select(F.col("aoi_id").cast("string").alias("name"), "west", "south", (F.col("west") + 60_000).alias("east"), (F.col("south") + 60_000).alias("north"))


_MET = "met AS (SELECT ce.name, tl.tile FROM ce JOIN tl ON ce.west < tl.east AND tl.west < ce.east AND ce.south < tl.north AND tl.south < ce.north)"


@query("tile_combinations", f"WITH {_TILES}, {_CELLS}, {_MET} SELECT a.name, a.tile AS t1, b.tile AS t2 FROM met a JOIN met b ON a.name = b.name AND a.tile < b.tile", "aoi_boxes")
def tile_combinations(spark, d):
    met = joins.box_pairs(_cells(spark, d), "name", _s2_tiles(spark, d), "tile", 200_000, touch=False)
    return grids.tile_combinations(met, "name", "tile", 2)


# The middles of the rectangles into which the sides of its tiles cut a cell.
_PT = """cut AS (SELECT met.name, greatest(tl.west, ce.west) AS w, least(tl.east, ce.east) AS e, greatest(tl.south, ce.south) AS s, least(tl.north, ce.north) AS n FROM met JOIN tl USING (tile) JOIN ce ON ce.name = met.name),
xs AS (SELECT name, w AS x FROM cut UNION SELECT name, e FROM cut UNION SELECT name, west FROM ce UNION SELECT name, east FROM ce), ys AS (SELECT name, s AS y FROM cut UNION SELECT name, n FROM cut UNION SELECT name, south FROM ce UNION SELECT name, north FROM ce),
xm AS (SELECT name, (x + lead(x) OVER (PARTITION BY name ORDER BY x)) / 2 AS px FROM xs), ym AS (SELECT name, (y + lead(y) OVER (PARTITION BY name ORDER BY y)) / 2 AS py FROM ys),
pt AS (SELECT name, px, py FROM xm JOIN ym USING (name) WHERE px IS NOT NULL AND py IS NOT NULL), np AS (SELECT name, count(*) AS np FROM pt GROUP BY name)"""
_HOLD = "hold AS (SELECT met.name, tl.tile, px, py FROM met JOIN tl USING (tile) JOIN pt ON pt.name = met.name AND px BETWEEN tl.west AND tl.east AND py BETWEEN tl.south AND tl.north)"
_COMBO = """co AS (SELECT name, 1 AS n, [tile] AS ts FROM met UNION ALL SELECT a.name, 2, [a.tile, b.tile] FROM met a JOIN met b ON a.name = b.name AND a.tile < b.tile
 UNION ALL SELECT a.name, 3, [a.tile, b.tile, c.tile] FROM met a JOIN met b ON a.name = b.name AND a.tile < b.tile JOIN met c ON a.name = c.name AND b.tile < c.tile
 UNION ALL SELECT a.name, 4, [a.tile, b.tile, c.tile, d.tile] FROM met a JOIN met b ON a.name = b.name AND a.tile < b.tile JOIN met c ON a.name = c.name AND b.tile < c.tile JOIN met d ON a.name = d.name AND c.tile < d.tile)"""


@query("assign_s2_tiles", f"""WITH {_TILES}, {_CELLS}, {_MET}, {_PT}, {_HOLD}, {_COMBO},
ok AS (SELECT co.name, n, array_to_string(ts, ',') AS tiles FROM co JOIN hold ON hold.name = co.name AND list_contains(ts, hold.tile) JOIN np ON np.name = co.name GROUP BY co.name, n, ts, np HAVING count(DISTINCT (px, py)) = np),
al AS (SELECT * FROM ok UNION ALL SELECT name, 9, string_agg(tile, ',' ORDER BY tile) FROM met GROUP BY name),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n, tiles) AS k FROM al)
SELECT name, CASE n WHEN 1 THEN 'single' WHEN 2 THEN 'pair' WHEN 3 THEN 'triple' WHEN 4 THEN 'quad' ELSE 'all' END AS match_type, tiles FROM r WHERE k = 1""", "aoi_boxes")
def assign_s2_tiles(spark, d):
    return grids.assign_tiles(_cells(spark, d), _s2_tiles(spark, d), 200_000)


@query("first_match_by_priority", f"WITH {_TILES}, {_CELLS}, {_MET} SELECT name, arg_min(tile, (CASE WHEN substr(tile, 4, 2) = '20' THEN 0 WHEN substr(tile, 2, 1) = '3' THEN 1 ELSE 2 END, tile)) AS tile FROM met GROUP BY name", "aoi_boxes")
def first_match_by_priority(spark, d):
    met = joins.box_pairs(_cells(spark, d), "name", _s2_tiles(spark, d), "tile", 200_000, touch=False)
    rank = F.when(F.substring("tile", 4, 2) == "20", 0).when(F.substring("tile", 2, 1) == "3", 1).otherwise(2)
    return met.groupBy("name").agg(F.min_by("tile", F.struct(rank, F.col("tile"))).alias("tile"))


@query("segmentize", "SELECT aoi_id, CAST(2 * ceil((east - west) / 250) + 2 * ceil((north - south) / 250) + 1 AS INT) AS n_points FROM aoi_boxes", "aoi_boxes")
def segmentize(spark, d):
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))])
    return joins.spread(view(spark, d, "aoi_boxes")).select("aoi_id", F.size(grids.segmentize(ring, 250.0)).alias("n_points"))


@query("collection_bbox", "SELECT label, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM ref_points GROUP BY label", "ref_points")
def collection_bbox(spark, d):
    return _points(spark, d).groupBy("label").agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))
