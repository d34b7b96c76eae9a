"""Outlines of tiles against the cells that they were made of."""

import random

import pytest
from pixelloom.operators import outlines as ol
from pyspark.sql import functions as F

BOX = "name string, west double, south double, east double, north double"


def inside(rings, x, y):
    """Even-odd rule at a place that no corner lies level with."""
    odd = False
    for r in rings:
        for a, b in zip(r, r[1:], strict=False):
            if (a["y"] > y) != (b["y"] > y) and a["x"] > x:
                odd = not odd
    return odd


def area(r):
    return sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(r, r[1:], strict=False)) / 2


def groups():
    rng = random.Random(7)
    ring = {(i, j) for i in range(3) for j in range(3)} - {(1, 1)}
    fixed = {"l": {(0, 0), (0, 1), (1, 0)}, "hole": ring, "corner": {(0, 0), (1, 1)}, "island": {(i, j) for i in range(5) for j in range(5)} - {(i, j) for i in range(1, 4) for j in range(1, 4)} | {(2, 2)}}
    return fixed | {f"r{k}": {(i - 4, j - 4) for i in range(8) for j in range(8) if rng.random() < 0.15 + 0.1 * k} for k in range(7)}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(k, i * 20.0, j * 20.0, i * 20.0 + 20, j * 20.0 + 20) for k, cells in groups().items() for i, j in cells]
    rows += rows[:5] + [("l", 0.0, 0.0, 20.0, 40.0), ("wide", -40.0, 0.0, 100.0, 20.0), (None, 0.0, 0.0, 20.0, 20.0), ("flat", 0.0, 0.0, 0.0, 20.0), ("null", None, 0.0, 20.0, 20.0)]
    out = ol.outlines(spark.createDataFrame(rows, BOX), F.col("name"), "name", 20)
    return {r.name: r for r in out.select("name", "rings", *[m.alias(n) for m, n in zip(ol.measures(F.col("rings")), ("parts", "area", "length", "corners"), strict=True)]).collect()}


def test_outlines_hold_exactly_the_cells(found):
    for k, cells in groups().items():
        for i in range(-6, 10):
            for j in range(-6, 10):
                assert inside(found[k].rings, i * 20 + 10, j * 20 + 10) == ((i, j) in cells), (k, i, j)


def test_parts_holes_and_measures(found):
    signs = {k: sorted(area(x) for x in r.rings) for k, r in found.items()}
    assert signs["l"] == [1200] and len(found["l"].rings[0]) == 7
    assert signs["hole"] == [-400, 3600]
    assert signs["corner"] == [400, 400]  # parts that touch by a corner are apart
    assert signs["island"] == [-3600, 400, 10000]
    for k, cells in groups().items():
        sides = sum((i + a, j + b) not in cells for i, j in cells for a, b in ol.STEPS)
        assert (found[k].area, found[k].length) == (400 * len(cells), 20 * sides)
        assert found[k].parts == sum(1 if a > 0 else -1 for a in signs[k])
        assert found[k].corners == sum(len(r) - 1 for r in found[k].rings)


def test_odd_rows(found):
    assert "flat" not in found and "null" not in found
    assert found[None].area == 400
    assert [(p["x"], p["y"]) for p in found["wide"].rings[0]] == [(-40, 0), (100, 0), (100, 20), (-40, 20), (-40, 0)]


def test_no_tiles(spark):
    assert ol.outlines(spark.createDataFrame([], BOX), F.col("name"), "name", 20).collect() == []
