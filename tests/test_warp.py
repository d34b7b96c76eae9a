"""Resampling to another projection, against NumPy with the projections of the column expressions."""

import math

import pytest
from pixelloom.operators import warp as warps
from pixelloom.operators.warp import Grid, between, mosaic, warp
from pyspark.sql import functions as F

UTM, LAEA = Grid(32631, 600_000.0, 5_700_000.0, 100.0), Grid(3035, 3_932_000.0, 3_165_000.0, 130.0)


@pytest.fixture(scope="module")
def cube(spark):
    """30 x 20 pixels from (-7, -3) on, at two times; gaps, nulls and a repeated pixel."""
    rows = [(t, x - 7, y - 3, float(x * y + 10 * t) if (x + y) % 9 else None, x + y) for t in (0, 1) for x in range(30) for y in range(20) if (x * 7 + y * 3 + t) % 11]
    return spark.createDataFrame([*rows, (0, 0, 0, -1.0, 0), (0, 0, 0, 5.0, 0)], "t int, x int, y int, a double, b int")


def brute(spark, cube, source, target, method):
    """Every target pixel of a generous frame, one at a time."""
    have = {}
    for r in sorted(cube.collect(), key=lambda r: (r.a is not None, r.a or 0, r.b), reverse=True):
        have[r.t, r.x, r.y] = (r.a, r.b)
    frame = spark.range(-60, 80).select(F.col("id").alias("tx")).crossJoin(spark.range(-60, 80).select(F.col("id").alias("ty")))
    out = {}
    for r in frame.select("tx", "ty", between(target, source, F.col("tx") + 0.5, F.col("ty") + 0.5).alias("p")).collect():
        for t in (0, 1):
            if method == "near":
                at = have.get((t, math.floor(r.p.u), math.floor(r.p.v)))
                if at:
                    out[t, r.tx, r.ty] = at
                continue
            u, v = r.p.u - 0.5, r.p.v - 0.5
            x, y = math.floor(u), math.floor(v)
            taps = [(have[t, x + i, y + j], (u - x if i else 1 - u + x) * (v - y if j else 1 - v + y)) for i in (0, 1) for j in (0, 1) if (t, x + i, y + j) in have]
            taps = [(c, w) for c, w in taps if w > 1e-6]
            if taps:
                mean = lambda k, taps=taps: sum(c[k] * w for c, w in taps if c[k] is not None) / s if (s := sum(w for c, w in taps if c[k] is not None)) else None
                out[t, r.tx, r.ty] = (mean(0), mean(1))
    return out


@pytest.mark.parametrize("method", ["near", "bilinear"])
@pytest.mark.parametrize("block", [4, 64])
@pytest.mark.parametrize("target", [LAEA, Grid(4326, 4.40, 51.46, 0.0011), Grid(32632, 180_000.0, 5_716_000.0, 250.0)])
def test_warp_equals_brute_force(spark, cube, method, block, target):
    got = {(r.t, r.x, r.y): (r.a, r.b) for r in warp(cube, ["a", "b"], UTM, target, method, block=block).collect()}
    want = brute(spark, cube, UTM, target, method)
    assert got.keys() == want.keys() and len(got) > 50
    for k, v in want.items():
        assert got[k] == pytest.approx(v) or [x is None for x in got[k]] == [x is None for x in v] == [True, False]


def test_each_pixel_once_and_kinds_stay(cube):
    out = warp(cube, ["a", "b"], UTM, LAEA, block=8)
    assert out.count() == out.select("t", "x", "y").distinct().count()
    assert dict(out.dtypes) == {"t": "int", "x": "int", "y": "int", "a": "double", "b": "int"}


def test_same_grid_is_the_same_cube(cube):
    one = cube.where("t = 1")
    for method in ("near", "bilinear"):
        out = warp(one, ["b"], UTM, UTM, method, block=8)
        assert {(r.x, r.y): round(r.b, 6) for r in out.collect()} == {(r.x, r.y): r.b for r in one.collect()}


def test_plan_joins_blocks_not_pixels(cube):
    plan = warp(cube, ["a"], UTM, LAEA)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 1 and "bx" in joins[0] and "by" in joins[0] and "tx" not in joins[0]


def test_mosaic_takes_the_first_layer(spark):
    a = spark.createDataFrame([(1, 0, 0, None), (1, 0, 1, 2.0)], "t int, x int, y int, a double")
    b = spark.createDataFrame([(1, 0, 1, 9.0), (1, 0, 2, 3.0)], "t int, x int, y int, a double")
    assert {(r.x, r.y): r.a for r in mosaic([a, b], ["a"]).collect()} == {(0, 0): None, (0, 1): 2.0, (0, 2): 3.0}


def test_empty_cube_and_unknown_arguments(cube):
    assert warp(cube.where("false"), ["a"], UTM, LAEA).count() == 0
    with pytest.raises(ValueError):
        warp(cube, ["a"], UTM, LAEA, "cubic")
    with pytest.raises(ValueError):
        Grid(32661, 0, 0, 1)
    with pytest.raises(ValueError):
        Grid(3035, 0, 0, 0)


def test_near_blocks_hold_only_pixels_that_a_date_has(spark):
    sparse = spark.range(500).selectExpr("CAST(id AS INT) AS t", "CAST(id % 7 AS INT) AS x", "CAST(id % 5 AS INT) AS y", "CAST(id AS DOUBLE) AS a")
    out = warp(sparse, ["a"], UTM, LAEA, block=16)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    dates = [line for line in plan.splitlines() if "[t#" in line]
    assert dates and not any("array_repeat" in line for line in dates)  # no dense blocks
    served = {(r.x, r.y): r.n for r in warp(sparse.selectExpr("0 AS t", "x", "y", "y * 7 + x AS c").distinct(), ["c"], UTM, LAEA, block=16).groupBy("c").count().selectExpr("c % 7 AS x", "c DIV 7 AS y", "count AS n").collect()}
    assert out.count() == sum(served.get((i % 7, i % 5), 0) for i in range(500)) > 0


@pytest.mark.parametrize("method", ["near", "bilinear"])
def test_blocks_drawn_out_or_off_the_range_cost_few_tries(spark, method):
    """Near the antipode of the target's centre a block is a long bow in a large box; a turn of the Earth further on no centre leads back to it."""
    source, target, block = Grid(32632, 270_000.0, 5_700_000.0, 1000.0), Grid(3035, 3_990_000.0, 3_180_000.0, 2000.0), 16
    shift = 0.5 if method == "bilinear" else 0.0
    by = 1240  # rows 19840 to 19855
    blocks = spark.createDataFrame([(0, by), (0, by + 2500)], "bx int, by int")
    outline = places_around(spark, source, target, block, by)
    west, east, top, foot = min(u for u, _ in outline) - 4, max(u for u, _ in outline) + 4, min(v for _, v in outline) - 4, max(v for _, v in outline) + 4
    box = spark.createDataFrame([(0, by, 0, int(west), int(east), int(top), int(foot)), (0, by + 2500, 0, int(west), int(east), int(top), int(foot))], "bx int, by int, part int, left int, right int, first int, last int")
    kept = warps._meeting(warps._cut(box, 8), source, target, shift, block)
    pixels = F.expr("(right - left + 1) * (last - first + 1)")
    every, tried = box.where(F.col("by") == by).select(pixels).first()[0], {r.by: r.n for r in kept.groupBy("by").agg(F.sum(pixels).alias("n")).collect()}
    assert every > 200_000 and tried[by] < every / 20 and tried.get(by + 2500, 0) < every / 20
    got = {(r.tx, r.ty) for r in warps.targets(blocks, source, target, method, block).collect()}
    frame = spark.range(int(west), int(east) + 1).select(F.col("id").alias("tx")).crossJoin(spark.range(int(top), int(foot) + 1).select(F.col("id").alias("ty")))
    places = warps._placed(frame, target, source, F.col("tx") + 0.5, F.col("ty") + 0.5).collect()
    assert got == {(r.tx, r.ty) for r in places if r.u == r.u and math.floor((r.u - shift) / block) == 0 and math.floor((r.v - shift) / block) == by} and got


def places_around(spark, source, target, block, by):
    """(u, v) in the target of places along the sides of a block of column 0."""
    at = [(a * block / 64, by * block + b * block) for a in range(65) for b in (0, 1)] + [(b * block, by * block + a * block / 64) for a in range(65) for b in (0, 1)]
    frame = spark.createDataFrame([(float(x), float(y)) for x, y in at], "x double, y double")
    return [(r.u, r.v) for r in warps._placed(frame, source, target, F.col("x"), F.col("y")).collect()]
