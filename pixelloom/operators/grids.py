"""Tiling grids: LAEA and UTM grids, dissolving, tilers and the choice of Sentinel-2 tiles for grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelloom.functions import crs, grid
from pixelloom.operators.joins import BOX, box_pairs

# The 100 km cells of the European grid.
LAEA_EAST, LAEA_NORTH = (9, 80), (8, 75)


def laea_100k(spark: SparkSession) -> DataFrame:
    """name and box of the 100 km tiles."""
    east = spark.range(LAEA_EAST[0], LAEA_EAST[1] + 1).select(F.col("id").alias("e"))
    cells = east.withColumn("n", F.explode(F.sequence(F.lit(LAEA_NORTH[0]), F.lit(LAEA_NORTH[1]))))
    name = F.concat(F.lit("E"), F.lpad(F.col("e").cast("string"), 2, "0"), F.lit("N"), F.lpad(F.col("n").cast("string"), 2, "0"))
    w, s = F.col("e") * 100_000, F.col("n").cast("long") * 100_000
    return cells.select(name.alias("name"), w.alias("west"), s.alias("south"), (w + 100_000).alias("east"), (s + 100_000).alias("north"))


def laea_children(parents: DataFrame, size_km: int) -> DataFrame:
    """The 50 km or 20 km tiles of 100 km tiles; their ids count 10 km."""
    n, step = 100 // size_km, size_km * 1000
    out = parents.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    w, s = F.col("west") + F.col("i") * step, F.col("south") + F.col("j") * step
    part = lambda v: F.lpad(F.floor(v / 10_000).cast("string"), 3, "0")
    name = F.concat(F.lit("E"), part(w), F.lit("N"), part(s))
    return out.select(name.alias("name"), F.col("name").alias("parent"), w.alias("west"), s.alias("south"), (w + step).alias("east"), (s + step).alias("north"))


def utm_20k(points: DataFrame) -> DataFrame:
    """(grid20id, epsg, box) of the 20 km UTM cells that hold points with zone_number, north, easting and northing; boxes snapped outward to 100 m."""
    cell = lambda v: F.floor(F.col(v) / 20_000) * 20_000
    rows = points.select("zone_number", "north", cell("easting").alias("w"), cell("northing").alias("s")).distinct()
    mid = (F.col("w") + 10_000, F.col("s") + 10_000)
    snap = lambda v, f: (f(v / 100) * 100).cast("long")
    return rows.select(
        grid.grid20_id(F.col("zone_number"), F.col("north"), *mid).alias("grid20id"), grid.utm_epsg(F.col("zone_number"), F.col("north")).alias("epsg"),
        snap(F.col("w"), F.floor).alias("west"), snap(F.col("s"), F.floor).alias("south"), snap(F.col("w") + 20_000, F.ceil).alias("east"), snap(F.col("s") + 20_000, F.ceil).alias("north"),
    )


def dissolve(tiles: DataFrame, key: Column, name: str) -> DataFrame:
    """(name, box, n_tiles): the bounds of the tiles of each key."""
    return tiles.groupBy(key.alias(name)).agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"), F.count("*").alias("n_tiles"))


def processing_grid(tiles: DataFrame) -> DataFrame:
    """(id, level, box, n_tiles): 20 km tiles with the 100 km tiles and strips that they form, from column grid20id."""
    parts = []
    for level, n in (("tile", 7), ("grid100", 5), ("strip", 6)):
        parts.append(dissolve(tiles, F.substring("grid20id", 1, n), "id").withColumn("level", F.lit(level)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def collect_tiles(df: DataFrame, key: Column, name: str, tiles: str) -> DataFrame:
    """(name, tiles): the sorted union of comma-separated tile lists for each key, as such a list."""
    ids = F.explode(F.split(F.col(tiles), ","))
    once = df.select(key.alias(name), ids.alias("t")).select(name, F.trim("t").alias("t")).distinct()
    return once.groupBy(name).agg(F.array_join(F.array_sort(F.collect_list("t")), ",").alias(tiles))


def tile_combinations(candidates: DataFrame, cell: str, tile: str, n: int) -> DataFrame:
    """(cell, t1..tn): all n-combinations of a cell's candidate tiles, ascending. A cell has a few candidates, never a growing group."""
    out = candidates.select(cell, F.col(tile).alias("t1"))
    for i in range(2, n + 1):
        more = candidates.select(F.col(cell).alias("_c"), F.col(tile).alias(f"t{i}"))
        out = out.join(more, (F.col(cell) == F.col("_c")) & (F.col(f"t{i - 1}") < F.col(f"t{i}"))).drop("_c")
    return out


def assign_tiles(cells: DataFrame, tiles: DataFrame, cell: float, most: int = 4) -> DataFrame:
    """(name, match_type, tiles): for each cell the fewest tiles whose boxes cover it, exactly.

    A single tile that contains the cell, first by id; else two, three, or four tiles that together cover it, first by
    ids; else all that meet it. Cells without tiles have no row.

    The sides of a cell's few candidates cut it into elementary rectangles; tiles cover the cell if and only if they hold
    the middle of each. Candidates that lie within another with a smaller id are left out, then sets are searched by size,
    each tile taking away the rectangles that it holds. One join by coarse cells, then one row for each cell.
    """
    met = box_pairs(cells, "name", tiles, "tile", cell, touch=False).join(tiles.select("tile", *BOX), "tile")
    own = met.groupBy("name").agg(F.array_sort(F.collect_set(F.struct("tile", *BOX))).alias("c")).join(cells.select("name", *BOX), "name")
    clip = lambda t: F.struct(t["tile"].alias("tile"), F.greatest(t["west"], "west").alias("w"), F.greatest(t["south"], "south").alias("s"), F.least(t["east"], "east").alias("e"), F.least(t["north"], "north").alias("n"))
    own = own.select("name", "west", "south", "east", "north", F.transform("c", clip).alias("c"))
    within = lambda t, o: (o["tile"] < t["tile"]) & (o["w"] <= t["w"]) & (o["s"] <= t["s"]) & (o["e"] >= t["e"]) & (o["n"] >= t["n"])
    own = own.withColumn("k", F.filter("c", lambda t: ~F.exists("c", lambda o: within(t, o))))

    def middles(lo: str, hi: str, first: str, last: str) -> Column:
        sides = F.array_sort(F.array_distinct(F.concat(F.transform("k", lambda t: t[lo].cast("double")), F.transform("k", lambda t: t[hi].cast("double")), F.array(F.col(first).cast("double"), F.col(last).cast("double")))))
        return F.transform(F.array(sides), lambda v: F.transform(F.slice(v, 1, F.size(v) - 1), lambda x, i: (x + F.get(v, i + 1)) / 2))[0]

    own = own.withColumn("xs", middles("w", "e", "west", "east")).withColumn("ys", middles("s", "n", "south", "north"))
    own = own.withColumn("p", F.flatten(F.transform("xs", lambda x: F.transform("ys", lambda y: F.struct(x.alias("x"), y.alias("y"))))))
    holds = lambda t, p: (p["x"] > t["w"]) & (p["x"] < t["e"]) & (p["y"] > t["s"]) & (p["y"] < t["n"])

    def sets(size: int, after: Column, left: Column) -> Column:
        """Sets of so many tiles after a place in the list that hold all that is left, as lists of ids."""
        if size == 1:
            return F.transform(F.filter("k", lambda t, i: (i > after) & F.forall(left, lambda p: holds(t, p))), lambda t: t["tile"])
        with_ = lambda t, i: F.when(i > after, F.transform(sets(size - 1, i, F.filter(left, lambda p: ~holds(t, p))), lambda ids: F.concat_ws(",", t["tile"], ids))).otherwise(F.array().cast("array<string>"))
        return F.flatten(F.transform("k", with_))

    kinds = ("single", "pair", "triple", "quad")[:most]
    found = [_named(kind, F.array_min(sets(n, F.lit(-1), F.col("p")))) for n, kind in enumerate(kinds, 1)]
    rest = F.struct(F.lit("all").alias("match_type"), F.array_join(F.transform("c", lambda t: t["tile"]), ",").alias("tiles"))
    return own.select("name", F.coalesce(*found, rest).alias("m")).select("name", "m.match_type", "m.tiles")


def _named(kind: str, ids: Column) -> Column:
    return F.transform(F.array(ids), lambda i: F.when(i.isNotNull(), F.struct(F.lit(kind).alias("match_type"), i.alias("tiles"))))[0]


def segmentize(ring: Column, step: float) -> Column:
    """A ring with points added so that no edge is longer than step."""
    edges = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))

    def split(e: Column) -> Column:
        a, b = e["a"], e["b"]
        n = F.greatest(F.ceil(F.hypot(b["x"] - a["x"], b["y"] - a["y"]) / step), F.lit(1)).cast("int")
        at = lambda i: F.struct((a["x"] + (b["x"] - a["x"]) * i / n).alias("x"), (a["y"] + (b["y"] - a["y"]) * i / n).alias("y"))
        return F.transform(F.sequence(F.lit(0), n - 1), at)

    last = F.element_at(ring, -1)
    return F.concat(F.flatten(F.transform(edges, split)), F.array(F.struct(last["x"].cast("double").alias("x"), last["y"].cast("double").alias("y"))))


def point_info(points: DataFrame, keep: list[str], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(keep, mgrs_id, mgrs_id10, mgrs_id1, center_lon, center_lat, grid20id) of positions in degrees.

    The ids are of 100 km, 10 m and 1 m squares and the 20 km grid; the centre is that of the 10 m pixel. Each projection is
    a column of its own, so it is evaluated once a row.
    """
    zone, north = F.col("_zone"), F.col("_north")
    at = points.select(*keep, grid.zone_letter(F.col(lat)).alias("_letter"), grid.zone_number(F.col(lon), F.col(lat)).alias("_zone"), (F.col(lat) >= 0).alias("_north"), F.col(lon).alias("_lon"), F.col(lat).alias("_lat"))
    at = at.withColumn("_utm", crs.utm_struct(F.col("_lon"), F.col("_lat"), zone, north))
    e, n = F.col("_utm.e"), F.col("_utm.n")
    at = at.withColumn("_mid", crs.lonlat_struct(grid.pixel_centre(e, 10), grid.pixel_centre(n, 10), zone, north))
    return at.select(
        *keep, grid.mgrs_id(zone, F.col("_letter"), e, n).alias("mgrs_id"), grid.mgrs_metres(zone, F.col("_letter"), e, n, 4).alias("mgrs_id10"), grid.mgrs_metres(zone, F.col("_letter"), e, n, 5).alias("mgrs_id1"),
        F.round("_mid.lon", 7).alias("center_lon"), F.round("_mid.lat", 7).alias("center_lat"), grid.grid20_id(zone, north, e, n).alias("grid20id"),
    )
