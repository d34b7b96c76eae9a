"""Joins of cubes, points and boxes. Spatial predicates become equi-joins on coarse cells with an exact test after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = ("west", "south", "east", "north")


#: Rows of a task that reduces or joins a cube by pixel: their groups take about 150 MB.
TASK_ROWS = 500_000


def by_rows(df: DataFrame) -> int | None:
    """Tasks of about TASK_ROWS rows for df, a core's worth at least, so that a task's memory doesn't grow with the input; None for a stream.

    Counts the rows when the plan is made: of Parquet without filters only its footers are read.
    """
    if df.isStreaming:
        return None
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def spread(df: DataFrame) -> DataFrame:
    """df dealt to four tasks a core: for few rows that are much work each, which a small file would leave to one task."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def merge_cubes(a: DataFrame, b: DataFrame, on: Sequence[str] = ("x", "y", "t"), tasks: int | None = None) -> DataFrame:
    """Full outer join of two cubes with different bands, in so many tasks if given; the union of their labels stays."""
    shared = (set(a.columns) & set(b.columns)) - set(on)
    if shared:
        raise ValueError(f"both cubes have {sorted(shared)}")
    if tasks:
        a, b = a.repartition(tasks, *on), b.repartition(tasks, *on)
    return a.join(b, list(on), "full_outer")


def merge_static(cube: DataFrame, static: DataFrame, how: str = "left") -> DataFrame:
    """A cube with the bands of one without time; Catalyst broadcasts the static side if its size allows."""
    return cube.join(static, ["x", "y"], how)


def cells(size: float, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Array of the (cx, cy) cells of a size grid that a box meets."""
    span = lambda a, b: F.sequence(F.floor(a / size), F.floor(b / size))
    return F.flatten(F.transform(span(west, east), lambda i: F.transform(span(south, north), lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def _meet(a: str, b: str, touch: bool) -> Column:
    lo, hi = (F.col(f"{a}.west"), F.col(f"{b}.east")), (F.col(f"{b}.west"), F.col(f"{a}.east"))
    lo2, hi2 = (F.col(f"{a}.south"), F.col(f"{b}.north")), (F.col(f"{b}.south"), F.col(f"{a}.north"))
    pairs = (lo, hi, lo2, hi2)
    out = None
    for p, q in pairs:
        test = p <= q if touch else p < q
        out = test if out is None else out & test
    return out


def box_pairs(a: DataFrame, a_id: str, b: DataFrame, b_id: str, cell: float, touch: bool = True) -> DataFrame:
    """(a_id, b_id) of boxes that meet (touching counts unless touch is false). Both sides are dealt to cells, so no pair of far boxes is made.

    A pair that meets in several cells is kept in the one of its joint south-west corner.
    """
    left = a.select(F.struct(F.col(a_id).alias("id"), *BOX).alias("a"), F.explode(cells(cell, *[F.col(c) for c in BOX])).alias("cell"))
    right = b.select(F.struct(F.col(b_id).alias("id"), *BOX).alias("b"), F.explode(cells(cell, *[F.col(c) for c in BOX])).alias("cell"))
    own = (F.floor(F.greatest("a.west", "b.west") / cell) == F.col("cell.cx")) & (F.floor(F.greatest("a.south", "b.south") / cell) == F.col("cell.cy"))
    met = left.join(right, "cell").where(_meet("a", "b", touch) & own)
    return met.select(F.col("a.id").alias(a_id), F.col("b.id").alias(b_id))


def tiles_of_aoi(tiles: DataFrame, tile_id: str, aoi: DataFrame, aoi_id: str, cell: float) -> DataFrame:
    """Tiles that meet any area of interest: a semi-join, each tile once."""
    return tiles.join(box_pairs(tiles, tile_id, aoi, aoi_id, cell).select(tile_id).distinct(), tile_id, "left_semi")


def spatial_left_join(tiles: DataFrame, tile_id: str, aoi: DataFrame, aoi_id: str, carry: Sequence[str], cell: float) -> DataFrame:
    """Every tile with the carried columns of each area that it meets; null for none."""
    pairs = box_pairs(tiles, tile_id, aoi, aoi_id, cell)
    return tiles.join(pairs, tile_id, "left").join(aoi.select(aoi_id, *carry), aoi_id, "left").select(*tiles.columns, aoi_id, *carry)


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is in a closed ring, an array of (x, y) structs: even-odd rule over the ring's edges."""
    edges = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        at = a["x"] + F.coalesce(F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"]), F.lit(0.0))
        return ((a["y"] > y) != (b["y"] > y)) & (x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1


def segment_meets_box(a: Column, b: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether the segment between two (x, y) structs has a point in a closed box: the part of it inside each side's half-plane, intersected."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    low, high, out = [F.lit(0.0)], [F.lit(1.0)], F.lit(False)
    for p, q in ((-dx, a["x"] - west), (dx, east - a["x"]), (-dy, a["y"] - south), (dy, north - a["y"])):
        low.append(F.when(p < 0, q / p))
        high.append(F.when(p > 0, q / p))
        out = out | ((p == 0) & (q < 0))
    return ~out & (F.greatest(*low) <= F.least(*high))


def polygon_pairs(tiles: DataFrame, tile_id: str, aoi: DataFrame, aoi_id: str, ring: str, cell: float) -> DataFrame:
    """(tile_id, aoi_id) of the tiles (boxes) that a polygon meets, touching included; ring is a closed array of (x, y) structs.

    Pairs of meeting bounds come from box_pairs. Of those a polygon meets the tile if an edge does, or the tile is inside.
    """
    side = lambda f, c: f(F.transform(ring, lambda p: p[c]))
    bounds = aoi.select(aoi_id, side(F.array_min, "x").alias("west"), side(F.array_min, "y").alias("south"), side(F.array_max, "x").alias("east"), side(F.array_max, "y").alias("north"))
    near = box_pairs(tiles, tile_id, bounds, aoi_id, cell)
    both = near.join(tiles.select(tile_id, *BOX), tile_id).join(aoi.select(aoi_id, F.col(ring).alias("_ring")), aoi_id)
    edges = F.arrays_zip(F.slice("_ring", 1, F.size("_ring") - 1).alias("a"), F.slice("_ring", 2, F.size("_ring") - 1).alias("b"))
    box = [F.col(c) for c in BOX]
    meets = F.exists(edges, lambda e: segment_meets_box(e["a"], e["b"], *box)) | point_in_ring(F.col("west"), F.col("south"), F.col("_ring"))
    return both.where(meets).select(tile_id, aoi_id)


def sample_first(points: DataFrame, point_id: str, cube: DataFrame, bands: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Value of the cube at each point's pixel (x, y); of several rows the first by ``order``, then by the values."""
    hit = points.select(point_id, "x", "y").join(cube, ["x", "y"])
    picked = hit.groupBy(point_id).agg(F.min_by(F.struct(*bands), F.struct(*order, *bands)).alias("v"))
    return picked.select(point_id, *[F.col(f"v.{b}").alias(b) for b in bands])


def lookup(df: DataFrame, key: str, table: dict[str, str], default: str, name: str) -> DataFrame:
    """df with a column from a small map, or the default."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return df.withColumn(name, F.coalesce(F.try_element_at(pairs, F.col(key)), F.lit(default)))


def same_count(a: DataFrame, b: DataFrame) -> DataFrame:
    """(n_left, n_right, equal) of two frames in one row."""
    both = a.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(b.select(F.lit(0).alias("l"), F.lit(1).alias("r")))
    out = both.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("n_left"), F.coalesce(F.sum("r"), F.lit(0)).alias("n_right"))
    return out.withColumn("equal", F.col("n_left") == F.col("n_right"))
