"""Outlines of groups of tiles: sides that two cells share cancel, the others are chained into rings, holes included."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelloom.operators.joins import BOX
from pixelloom.operators.polygons import edges_of

#: Steps east, north, west and south.
STEPS = ((1, 0), (0, 1), (-1, 0), (0, -1))
RINGS = T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))


def boundary(tiles: DataFrame, key: Column, name: str, step: float) -> DataFrame:
    """(name, x, y, dir): the sides of unit cells that have cells of the group on one hand only, which is their left.

    Coordinates count steps; dir is a place in STEPS. Both counts are combined before they are shuffled, so a group that
    holds most of the tiles is spread over all tasks.
    """
    unit = lambda c: F.round(F.col(c) / step).cast("long")
    boxes = tiles.select(key.alias(name), *[unit(c).alias(c) for c in BOX]).where("west < east AND south < north")
    span = lambda lo, hi: F.explode(F.sequence(F.col(lo), F.col(hi) - 1))
    cells = boxes.withColumn("i", span("west", "east")).withColumn("j", span("south", "north")).select(name, "i", "j").distinct()
    side = lambda x, y, flat, sign: F.struct(x.alias("x"), y.alias("y"), F.lit(flat).alias("flat"), F.lit(sign).alias("sign"))
    i, j = F.col("i"), F.col("j")
    sides = cells.select(name, F.explode(F.array(side(i, j, True, 1), side(i, j + 1, True, -1), side(i, j, False, -1), side(i + 1, j, False, 1))).alias("s"))
    left = sides.groupBy(name, "s.x", "s.y", "s.flat").agg(F.sum("s.sign").alias("sign")).where("sign <> 0")
    back = F.when(F.col("sign") < 0, 1).otherwise(0)  # a side that runs west or south starts at its other end
    x, y = F.col("x") + F.when(F.col("flat"), back).otherwise(0), F.col("y") + F.when(F.col("flat"), 0).otherwise(back)
    return left.select(name, x.alias("x"), y.alias("y"), (F.when(F.col("flat"), 0).otherwise(1) + 2 * back).alias("dir"))


def chain(sides: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
    """Closed rings of corners from directed sides (x, y, dir), each starting at its least corner.

    Where two cells touch by a corner only, a ring turns left, so it stays with its cell.
    """
    left, rings = set(sides), []
    for first in sorted(sides):
        if first not in left:
            continue
        ring, at, before = [], first, None
        while at in left:
            left.remove(at)
            x, y, d = at
            if d != before:
                ring.append((x, y))
            x, y, before = x + STEPS[d][0], y + STEPS[d][1], d
            at = next((n for n in ((x, y, (d + t) % 4) for t in (1, 0, 3)) if n in left), None)
        rings.append([*ring, ring[0]])
    return rings


def outlines(tiles: DataFrame, key: Column, name: str, step: float) -> DataFrame:
    """(name, rings): the outline of each group of tiles (boxes) as rings, array<array<struct<x, y>>>.

    step: a length that all sides of tiles are multiples of, such as the side of the smallest. Outlines run
    counter-clockwise and holes clockwise, from their least corner; parts that touch by a corner only are rings of their
    own. Tiles may repeat or overlap; those without an extent or with a null side are left out, and a null key is a group.
    Inner sides are gone before a group's outline, which is its one row, meets in a task.
    """
    sides = boundary(tiles, key, name, step)
    kind = sides.schema[name].dataType

    def run(table: pa.Table) -> pa.Table:
        rings = chain(list(zip(*(table.column(c).to_pylist() for c in ("x", "y", "dir")), strict=True)))
        value = [[{"x": x * float(step), "y": y * float(step)} for x, y in ring] for ring in rings]
        point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
        return pa.table({name: table.column(name).slice(0, 1), "rings": pa.array([value], pa.list_(pa.list_(point)))})

    return sides.groupBy(name).applyInArrow(run, T.StructType([T.StructField(name, kind), T.StructField("rings", RINGS)]))


def ring_area(ring: Column) -> Column:
    """Area of a closed ring, below zero if it runs clockwise."""
    return F.aggregate(edges_of(F.array(ring)), F.lit(0.0), lambda a, e: a + (e["ax"] * e["by"] - e["bx"] * e["ay"]) / 2)


def measures(rings: Column) -> tuple[Column, Column, Column, Column]:
    """Outlines less holes, area, length and number of corners of rings."""
    count = F.aggregate(rings, F.lit(0), lambda n, r: n + F.signum(ring_area(r)).cast("int"))
    area = F.aggregate(rings, F.lit(0.0), lambda a, r: a + ring_area(r))
    length = F.aggregate(edges_of(rings), F.lit(0.0), lambda a, e: a + F.hypot(e["bx"] - e["ax"], e["by"] - e["ay"]))
    return count, area, length, F.size(edges_of(rings))
