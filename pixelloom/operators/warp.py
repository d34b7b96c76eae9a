"""Resampling to another projection: inverse warp of pixel blocks, nearest neighbour or bilinear."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelloom.functions import crs
METHODS = ("near", "bilinear")
#: Target rows that one row of a block's targets holds.
ROWS = 32
#: Target rows and columns of the tiles that are tried or not as a whole, from large to small.
TILES = (32, 8)
#: Weights up to this are those of a centre on a pixel's centre, and count as none.
TINY = 1e-6


@dataclass(frozen=True)
class Grid:
    """A raster's place: pixel (x, y) is x sizes east of west and y sizes south of north, in the units of the projection.

    epsg: 4326, 3035, or a UTM zone (326zz north, 327zz south).
    """

    epsg: int
    west: float
    north: float
    size: float

    def __post_init__(self):
        if not (self.epsg in (4326, 3035) or self.epsg // 100 in (326, 327) and 1 <= self.epsg % 100 <= 60):
            raise ValueError(f"no projection for EPSG:{self.epsg}")
        if self.size <= 0:
            raise ValueError("size must be positive")

    def lonlat(self, x: Column, y: Column, let: crs.Let = crs.inline) -> tuple[Column, Column]:
        """(lon, lat) of a place in pixels; (0, 0) is the upper left corner of the first pixel."""
        e, n = self.west + x * self.size, self.north - y * self.size
        if self.epsg == 4326:
            return e, n
        return crs.from_laea(e, n, let) if self.epsg == 3035 else crs.from_utm(e, n, F.lit(self.epsg % 100), F.lit(self.epsg // 100 == 326), let)

    def pixels(self, lon: Column, lat: Column, let: crs.Let = crs.inline) -> Column:
        """Struct (u, v): the place of lon, lat in pixels, not rounded."""

        def place(p: Column) -> Column:
            return F.struct(((p["e"] - self.west) / self.size).alias("u"), ((self.north - p["n"]) / self.size).alias("v"))

        if self.epsg == 4326:
            point = F.struct(lon.alias("e"), lat.alias("n"))
        elif self.epsg == 3035:
            x, y = crs.to_laea(lon, lat, let)
            point = F.struct(x.alias("e"), y.alias("n"))
        else:
            point = crs.utm_struct(lon, lat, F.lit(self.epsg % 100), F.lit(self.epsg // 100 == 326), let)
        return let(point, place)


def between(source: Grid, target: Grid, x: Column, y: Column, let: crs.Let = crs.inline) -> Column:
    """Struct (u, v): a place in pixels of source as one in pixels of target; the geographic point is worked out once."""
    lon, lat = source.lonlat(x, y, let)
    return let(F.struct(lon.alias("lon"), lat.alias("lat")), lambda p: target.pixels(p["lon"], p["lat"], let))


def _placed(df: DataFrame, source: Grid, target: Grid, x: Column, y: Column) -> DataFrame:
    """df with u, v: a place in pixels of source as one in pixels of target, worked out step by step as columns."""
    let = crs.Staged(df)
    p = between(source, target, x, y, let)
    return let.df.select(*df.columns, p["u"].alias("u"), p["v"].alias("v"))


def _blocks(v: str, block: int, halo: int) -> Column:
    """The blocks that need pixel v: its own and, if the one before reaches over its edge, that."""
    own = F.floor(F.col(v) / block).cast("int")
    if not halo:
        return F.array(own)
    return F.when(F.pmod(F.col(v), F.lit(block)) < halo, F.array(own, own - 1)).otherwise(F.array(own))


def _cells(cube: DataFrame, bands: Sequence[str], keys: Sequence[str], block: int, halo: int) -> DataFrame:
    """(keys, bx, by, e): the pixels that a block has, as structs (i, v) in the order of their place i; of several rows of a pixel the least."""
    wide = block + halo
    dealt = cube.select(*keys, "x", "y", F.struct(*bands).alias("v")).withColumn("bx", F.explode(_blocks("x", block, halo))).withColumn("by", F.explode(_blocks("y", block, halo)))
    place = ((F.col("y") - F.col("by") * block) * wide + F.col("x") - F.col("bx") * block).cast("int")
    rows = dealt.groupBy(*keys, "bx", "by").agg(F.array_sort(F.collect_list(F.struct(place.alias("i"), "v"))).alias("e"))
    return rows.withColumn("e", F.filter("e", lambda p, k: (k == 0) | (F.get("e", k - 1)["i"] != p["i"])))


def pack(cube: DataFrame, bands: Sequence[str], keys: Sequence[str] = (), block: int = 64, halo: int = 0) -> DataFrame:
    """(keys, bx, by, cells): blocks of pixels as dense arrays, row by row, one shuffle; an absent pixel is null.

    A block is block + halo pixels wide and high: it repeats the first columns and rows of its neighbours. Of several rows
    of a pixel the least by its bands counts.
    """
    wide = block + halo
    rows = _cells(cube, bands, keys, block, halo)
    none = F.lit(None).cast(rows.schema["e"].dataType.elementType["v"].dataType)
    gaps = F.transform("e", lambda p, k: F.concat(F.array(p["v"]), F.array_repeat(none, F.coalesce(F.get("e", k + 1)["i"], F.lit(wide * wide)) - p["i"] - 1)))
    return rows.select(*keys, "bx", "by", F.concat(F.array_repeat(none, F.col("e")[0]["i"]), F.flatten(gaps)).alias("cells"))


def _around(df: DataFrame, west: Column, top: Column, east: Column, foot: Column, steps: int) -> DataFrame:
    """df with rows for places x, y along the sides of a box, ``steps`` to a side."""
    ends = [i / steps for i in range(steps)]
    unit = [p for s in ends for p in ((s, 0.0), (1.0, s), (1.0 - s, 1.0), (0.0, 1.0 - s))]
    point = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in unit])).alias("_p")
    return df.select("*", point).select(*df.columns, (west + F.col("_p.a") * (east - west)).alias("x"), (top + F.col("_p.b") * (foot - top)).alias("y"))


def _cut(tiles: DataFrame, size: int) -> DataFrame:
    """Tiles (left, right, first, last) cut into some of up to size rows and columns."""
    for low, high in (("left", "right"), ("first", "last")):
        tiles = tiles.withColumn("_at", F.explode(F.sequence(low, high, F.lit(size)))).withColumn(low, F.col("_at")).withColumn(high, F.least(high, F.col("_at") + size - 1)).drop("_at")
    return tiles


def _meeting(tiles: DataFrame, source: Grid, target: Grid, shift: float, block: int) -> DataFrame:
    """The tiles whose outline, carried back to the source and widened by a quarter, meets their block (bx, by).

    One on the rim of EPSG:3035, which is a disk of 12,742 km, is kept; one wholly off it isn't, unless the disk fits in.
    """
    corners = _around(tiles, F.col("left"), F.col("first"), F.col("right") + 1, F.col("last") + 1, 4)
    back = _placed(corners, target, source, F.col("x"), F.col("y")).groupBy(*tiles.columns)
    off = F.isnan("u") | F.isnan("v")
    rim = ~F.min(off) | F.lit(target.size * TILES[0] > 12_000_000)
    bounds = back.agg(F.max(off).alias("off"), rim.alias("rim"), *[f(c).alias(f"{c}{i}") for c in "uv" for i, f in enumerate((F.min, F.max))])
    meets = F.lit(True)
    for c, k in (("u", "bx"), ("v", "by")):
        wide = 1 + (F.col(f"{c}1") - F.col(f"{c}0")) / 4
        meets = meets & (F.col(f"{c}1") - shift >= F.col(k) * block - wide) & (F.col(f"{c}0") - shift <= (F.col(k) + 1) * block + wide)
    return bounds.where(F.when(F.col("off"), F.col("rim")).otherwise(meets)).select(*tiles.columns)


def targets(blocks: DataFrame, source: Grid, target: Grid, method: str, block: int) -> DataFrame:
    """(bx, by, part, tx, ty, u, v): for each source block the target pixels whose centres it serves, with their places; part: of ROWS target rows.

    A block serves the centres whose nearest pixel, or whose upper left pixel of the four around, is its own: so each centre
    has one block. The outline of the block, with points along its sides, bounds the target rows and columns to try; where
    the projection draws it out into a long bow, that is a large box for few pixels. So the box is cut into tiles, large and
    then small, and only those are tried whose own outline, carried back, meets the block. Work is then about the block's
    own pixels, and next to none for blocks off the projection's range, which no centre leads back to.
    """
    shift = 0.5 if method == "bilinear" else 0.0
    many, keys = 4 * blocks.sparkSession.sparkContext.defaultParallelism, ["bx", "by"]
    west, top = F.col("bx") * block + shift, F.col("by") * block + shift
    outline = _around(blocks.repartition(many, *keys), west, top, west + block, top + block, 8)
    seen = _placed(outline, source, target, F.col("x"), F.col("y"))
    some = lambda c: F.nanvl(c, F.lit(None).cast("double"))
    reach = lambda c, end: (F.floor(F.min(some(c))) - 1 if end < 0 else F.floor(F.max(some(c))) + 1).cast("int")
    spans = seen.groupBy(*keys).agg(reach("u", -1).alias("west"), reach("u", 1).alias("east"), reach("v", -1).alias("top"), reach("v", 1).alias("foot"))
    parts = spans.withColumn("part", F.explode(F.sequence(F.floor(F.col("top") / ROWS), F.floor(F.col("foot") / ROWS))))
    own_rows = F.greatest("top", F.col("part") * ROWS).cast("int"), F.least("foot", F.col("part") * ROWS + ROWS - 1).cast("int")
    tried = parts.select(*keys, "part", F.col("west").alias("left"), F.col("east").alias("right"), own_rows[0].alias("first"), own_rows[1].alias("last"))
    for size in TILES:
        tried = _meeting(_cut(tried, size).repartition(many, *keys, "left", "first"), source, target, shift, block)
    tried = tried.select(*keys, "part", F.explode(F.sequence("left", "right")).alias("tx"), "first", "last")
    tried = tried.select(*keys, "part", "tx", F.explode(F.sequence("first", "last")).alias("ty"))
    # the row number keeps the filter behind the places: pushed below them, it would work them out again
    placed = _placed(tried, target, source, F.col("tx") + 0.5, F.col("ty") + 0.5).select(*tried.columns, (F.col("u") - shift).alias("u"), (F.col("v") - shift).alias("v"), F.monotonically_increasing_id().alias("_row"))
    own = (F.floor(F.col("u") / block) == F.col("bx")) & (F.floor(F.col("v") / block) == F.col("by"))
    return placed.where(own & (F.col("_row") >= 0)).drop("_row")


def warp(cube: DataFrame, bands: Sequence[str], source: Grid, target: Grid, method: str = "near", keys: Sequence[str] = ("t",), block: int = 64) -> DataFrame:
    """(keys, x, y, bands) on the target grid: the cube of the source grid resampled to another projection and pixel size.

    near: the source pixel that holds a target pixel's centre, or no row. bilinear: the mean of the four source pixels
    around the centre, by their distances, over those present and not null; a row if any with a weight is there.

    Source pixels are packed into blocks by one shuffle. For every block of the grid, not of every date, the target pixels
    that it serves are worked out by the inverse projections in closed form and joined to the packed blocks: no join meets
    single pixels. near: a block holds the pixels that a date has, and each looks up those that it serves, so work is rows
    and results however few pixels a date has. bilinear: it is a dense array, out of which each target takes its values.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    halo = int(method == "bilinear")
    wide = block + halo
    near = cube.select("x", "y").withColumn("bx", F.explode(_blocks("x", block, halo))).withColumn("by", F.explode(_blocks("y", block, halo))).select("bx", "by").distinct()
    served = targets(near, source, target, method, block)
    if not halo:
        each = served.groupBy("part", F.floor("u").alias("x"), F.floor("v").alias("y"))
        places = pack(each.agg(F.collect_list(F.struct("tx", "ty")).alias("to")), ["to"], ("part",), block)
        met = _cells(cube, bands, keys, block, 0).join(places.drop("part"), ["bx", "by"])
        serve = lambda p: F.transform(F.get("cells", p["i"])["to"], lambda q: F.struct(q["tx"], q["ty"], p["v"]))
        found = F.flatten(F.transform(F.filter("e", lambda p: F.get("cells", p["i"]).isNotNull()), serve))
        out = met.select(*keys, F.explode(found).alias("p"))
        return out.select(*keys, F.col("p.tx").alias("x"), F.col("p.ty").alias("y"), *[f"p.v.{b}" for b in bands])
    dealt = served.groupBy("bx", "by", "part").agg(F.collect_list(F.struct("tx", "ty", "u", "v")).alias("at"))
    met = pack(cube, bands, keys, block, halo).join(dealt, ["bx", "by"])

    # flat rows and plain sums, as lambdas aren't compiled
    each = met.select(*keys, "bx", "by", "cells", F.explode("at").alias("p")).select("*", F.floor("p.u").alias("_x"), F.floor("p.v").alias("_y"))
    at = ((F.col("_y") - F.col("by") * block) * wide + F.col("_x") - F.col("bx") * block).cast("int")
    wx, wy = F.col("p.u") - F.col("_x"), F.col("p.v") - F.col("_y")
    weights = {f"_w{dy}{dx}": (wx if dx else 1 - wx) * (wy if dy else 1 - wy) for dy in (0, 1) for dx in (0, 1)}
    cells = {f"_v{dy}{dx}": F.get("cells", at + dy * wide + dx) for dy in (0, 1) for dx in (0, 1)}
    taps = each.select(*keys, F.col("p.tx").alias("x"), F.col("p.ty").alias("y"), *[c.alias(n) for n, c in (weights | cells).items()])
    some = [F.col(v).isNotNull() & (F.col(w) > TINY) for v, w in zip(cells, weights, strict=True)]
    return taps.where(some[0] | some[1] | some[2] | some[3]).select(*keys, "x", "y", *[_mean(b, list(cells), list(weights)).alias(b) for b in bands])


def _mean(band: str, cells: Sequence[str], weights: Sequence[str]) -> Column:
    total = weight = F.lit(0.0)
    for v, w in zip(cells, weights, strict=True):
        value, has = F.col(f"{v}.{band}"), (F.col(w) > TINY) & F.col(f"{v}.{band}").isNotNull()
        total, weight = total + F.when(has, F.col(w) * value.cast("double")).otherwise(0.0), weight + F.when(has, F.col(w)).otherwise(0.0)
    return F.try_divide(total, weight)


def mosaic(layers: Sequence[DataFrame], bands: Sequence[str], keys: Sequence[str] = ("t",)) -> DataFrame:
    """One cube of several on the same grid: of the rows of a pixel that of the first layer with one counts."""
    out = None
    for i, layer in enumerate(layers):
        part = layer.select(*keys, "x", "y", F.struct(F.lit(i).alias("layer"), *bands).alias("v"))
        out = part if out is None else out.unionByName(part)
    first = out.groupBy(*keys, "x", "y").agg(F.min_by("v", "v.layer").alias("v"))
    return first.select(*keys, "x", "y", *[f"v.{b}" for b in bands])
