"""Known answers, invariants, sources and plans."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pixelloom.functions import crs, grid, pixel
from pixelloom.operators import classify, grids, joins, spatial, temporal
from pixelloom.plans import catalog, cube
from pixelloom.plans.views import view
from pixelloom.sources import files

SF = "/root/testdata/sf0.001"


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_projection_anchors(spark):
    x, y = crs.to_laea(F.lit(5.0), F.lit(50.0))
    e, n = crs.to_utm(F.lit(-79.387139), F.lit(43.642567), F.lit(17), F.lit(True))
    got = one(spark, x, y, e, n)
    assert [round(v, 2) for v in got] == [3962799.45, 2999718.85, 630084.30, 4833438.59]


def test_bbox_of_utm(spark):
    lit = lambda *v: [F.lit(float(x)) for x in v]
    box = crs.reproject_bbox(*lit(630084.30, 4833438.59, 640000, 4843438), zone=F.lit(17), northern=F.lit(True))
    e, n = crs.to_utm(box["east"], box["north"], F.lit(17), F.lit(True))
    got = one(spark, box["west"], box["south"], e, n)
    assert [round(v, 5) for v in got[:2]] == [-79.38714, 43.64257] and [round(v, 2) for v in got[2:]] == [640000, 4843438]


def test_equal_area_of_the_globe(spark):
    area = crs.bbox_area_km2(F.lit(-180.0), F.lit(-90.0), F.lit(180.0), F.lit(90.0), lonlat=True)
    assert abs(one(spark, area)[0] - 510_065_621.7) < 1


@pytest.mark.parametrize("lon,lat,zone", [(5, 60, 32), (8, 75, 31), (20, 75, 33), (32, 75, 35), (41, 75, 37), (0, 0, 31), (-180, 10, 1), (179.9, 10, 60)])
def test_zones(spark, lon, lat, zone):
    assert one(spark, grid.zone_number(F.lit(float(lon)), F.lit(float(lat))))[0] == zone


def test_extent_and_parent(spark):
    box = grid.laea_extent(F.lit("E480N282"), 20)
    assert list(one(spark, *box.values())) == [4_800_000, 2_820_000, 4_820_000, 2_840_000]
    assert one(spark, grid.parent_100km(F.lit("E480N282")))[0] == "E48N28"


@pytest.mark.parametrize("period,day,start", [
    ("dekad", "2024-01-31", "2024-01-21"), ("dekad", "2024-02-29", "2024-02-21"), ("season", "2024-02-29", "2023-12-01"), ("season", "2024-12-05", "2024-12-01"),
    ("P1M", "2024-05-17", "2024-05-01"), ("week", "2024-05-19", "2024-05-13"), ("year", "2024-05-19", "2024-01-01"),
])
def test_periods(spark, period, day, start):
    assert str(one(spark, temporal.period_start(F.lit(day).cast("date"), period))[0]) == start


def test_statistics_of_four_values(spark):
    df = spark.createDataFrame([(0, 0, v) for v in (1.0, 2.0, 4.0, None)], "x int, y int, b double")
    got = temporal.temporal_features(df, ["b"]).first()
    assert [round(got[f"b_{s}"], 6) for s in ("p2", "p25", "median", "p75", "p98", "sd")] == [1.04, 1.5, 2, 3, 3.92, 1.527525]
    assert df.agg(temporal.reducers()["product"](F.col("b"))).first()[0] == 8


def test_feature_counts(spark):
    s1 = view(spark, SF, "refl_wide")
    opt = cube.options("feature", masking="classes")
    assert len(cube.s1_features(s1, opt).columns) - 2 == 42
    assert len(cube.master_features(s1, s1, opt).columns) - 2 == 237


def test_options_are_checked():
    for bad in ({"ts_interval": "hour"}, {"s2_reducer": "mode"}, {"masking": "x"}, {"optical": ("FOO",)}, {"max_cloud_cover": 101}, {"s1_orbit": "UP"}):
        with pytest.raises(ValueError):
            cube.options(**bad)
    with pytest.raises(ValueError):
        cube.options("unknown")


pixels = st.sets(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=40)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(on=pixels, r=st.integers(1, 4))
def test_disk_morphology(spark, on, r):
    df = spark.createDataFrame([(x, y, (x, y) in on) for x in range(13) for y in range(13)], "x int, y int, f boolean")
    grown = {(p.x, p.y) for p in spatial.dilate_disk(df, "f", r).where("f").collect()}
    shrunk = {(p.x, p.y) for p in spatial.erode_disk(df, "f", r).where("f").collect()}
    near = lambda p, q: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= r * r
    every = [(x, y) for x in range(13) for y in range(13)]
    assert grown == {p for p in every if any(near(p, q) for q in on)}
    assert shrunk == {p for p in every if all(q in on for q in every if near(p, q))}
    assert shrunk <= on <= grown


def test_interpolation_leaves_ends(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 7)]
    values = [None, 1.0, None, None, 4.0, None]
    df = spark.createDataFrame([(0, 0, d, v) for d, v in zip(days, values)], "x int, y int, t date, b double")
    got = [r.b for r in temporal.interpolate(df, ["b"]).orderBy("t").collect()]
    assert got == [None, 1.0, 2.0, 3.0, 4.0, None]
    assert [r.b for r in temporal.interpolate(df, ["b"], on_time=True).orderBy("t").collect()] == got


def test_constant_composite(spark):
    df = view(spark, SF, "refl_wide").withColumn("c", F.lit(7.0))
    for name in ("median", "mean", "max", "min", "first", "last"):
        assert {r.c for r in temporal.composite(df, ["c"], "dekad", name).select("c").distinct().collect()} == {7.0}


def test_scale_keeps_null(spark):
    got = one(spark, pixel.linear_scale(F.lit(None).cast("double"), 0, 1), pixel.linear_scale(F.lit(5.0), 0, 1), pixel.linear_scale(F.lit(-5.0), 0, 1, 1, 2))
    assert list(got) == [None, 1.0, 1.0]


def test_argmax_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5), (2, None, 0.1), (3, None, None), (4, None, -1.0)], "id int, a double, b double")
    got = {r.id: r.c for r in df.select("id", classify.argmax_wide(["a", "b"], [10, 20]).alias("c")).collect()}
    assert got == {1: 10, 2: 20, 3: None, 4: 10}


def test_two_parents_raise(spark):
    df = spark.createDataFrame([(10100,), (20100,)], "l2 int")
    with pytest.raises(ValueError):
        classify.check_one_parent(df, "l2", 2)


def test_point_in_ring(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0))])
    got = one(spark, *[joins.point_in_ring(F.lit(x), F.lit(y), ring) for x, y in ((1.0, 1.0), (2.0, 3.0), (3.5, 3.0), (5.0, 1.0))])
    assert list(got) == [True, False, True, False]


def test_segmentize(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (500, 0), (500, 100), (0, 0))])
    assert one(spark, F.size(grids.segmentize(ring, 250.0)))[0] == 2 + 1 + 3 + 1


def test_multipart_checksum(spark):
    got = one(spark, files.multipart_etag(F.encode(F.lit("abcdefghij"), "utf-8"), 4))[0]
    parts = [b"abcd", b"efgh", b"ij"]
    assert got == hashlib.md5(b"".join(hashlib.md5(p).digest() for p in parts)).hexdigest() + "-3" == "446feba4c1b5cc7ad93bf4d44a0e36ac-3"


def test_jdbc_round_trip(spark):
    url, driver = "jdbc:derby:memory:jobs;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(1, float("nan")), (2, 0.5)], "id int, v double")
    files.jdbc_insert(df, url, "t", **driver)
    assert sorted((r[0], r[1]) for r in files.jdbc_read(spark, url, "t", ["id", "v"], **driver).collect()) == [(1, None), (2, 0.5)]
    assert files.jdbc_query(spark, url, 'SELECT "id" FROM t WHERE "v" > 0', **driver).collect()[0][0] == 2


def test_xml_tiles(spark, tmp_path):
    (tmp_path / "t.kml").write_text("<kml><Document><Placemark><name>31UFS</name><description>EPSG 32631 MULTIPOLYGON(((0 0,1 0,1 1,0 0)))</description></Placemark><Placemark><name>33UVQ</name><description>32633 POLYGON((0 0,1 0,1 1,0 0))</description></Placemark></Document></kml>")
    got = files.read_xml_tiles(spark, str(tmp_path / "t.kml"), [31]).collect()
    assert [(r.tile_id, r.epsg, r.utm_wkt) for r in got] == [("31UFS", 32631, "MULTIPOLYGON(((0 0,1 0,1 1,0 0)))")]


def test_box_pairs_equal_brute_force(spark):
    boxes = view(spark, SF, "aoi_boxes").collect()
    df = view(spark, SF, "aoi_boxes")
    got = {(r.a, r.b) for r in joins.box_pairs(df.withColumnRenamed("aoi_id", "a"), "a", df.withColumnRenamed("aoi_id", "b"), "b", 130_000).collect()}
    meets = lambda p, q: p.west <= q.east and q.west <= p.east and p.south <= q.north and q.south <= p.north
    assert got == {(p.aoi_id, q.aoi_id) for p in boxes for q in boxes if meets(p, q)}


def test_plans(spark):
    plan = lambda df: df._jdf.queryExecution().toString()
    loaded = cube.load(view(spark, SF, "refl_wide"), ("B04",), "1997-01-01", "1998-01-01")
    text = plan(loaded)
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text and "l_extendedprice" not in text.split("ReadSchema")[1]
    names = [n for n in catalog.queries() if n not in ("minmax_scale", "pca_contribution_scores", "percentile_stretch") and not n.startswith("stream")]
    for name in ("spatial_join_left", "aoi_tiler", "assign_s2_tiles", "master_features", "satio_scl_mask"):
        assert name in names
        assert "CartesianProduct" not in plan(catalog.queries()[name](spark, SF))
    assert plan(cube.s1_features(view(spark, SF, "refl_wide"), cube.options("feature"))).split("== Physical Plan ==")[1].count("Exchange hashpartitioning") <= 2


def test_entry_without_the_optional_part(monkeypatch):
    """A library that only the training-data part needs is missing: all other queries are there."""
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "xxhash", None)
    for name in [m for m in sys.modules if m.startswith("pixelloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    entry = importlib.import_module("__spark_entry__")
    found = entry.queries()
    assert "flagship_ndvi_features" in found and not [q for q in found if q.startswith("op1_") or q == "pipeline"]
    assert entry.oracle_sql().keys() <= found.keys()


def test_dilate_square_over_absent_pixels(spark):
    import random

    from pixelloom.operators import spatial

    random.seed(2)
    cells = {(random.randrange(20), random.randrange(20), k): random.random() < 0.1 for k in (1, 2) for _ in range(60)} | {(30, 30, 1): True, (31, 31, 1): False}
    df = spark.createDataFrame([(*c, f) for c, f in cells.items()], "x int, y int, k int, f boolean")
    for size in (1, 2, 5, 9):
        want = {(x, y, k): any(f and j == k and abs(x - a) <= size // 2 and abs(y - b) <= size // 2 for (a, b, j), f in cells.items()) for x, y, k in cells}
        assert {(r.x, r.y, r.k): r.f for r in spatial.dilate_square(df, "f", size, ["k"]).collect()} == want
    assert spatial.dilate_square(df.where("NOT f"), "f", 5, ["k"]).where("f").count() == 0


def test_segments_and_polygons(spark):
    from pixelloom.operators import joins

    tiles = spark.createDataFrame([("a", 0.0, 0.0, 10.0, 10.0), ("b", 20.0, 0.0, 30.0, 10.0), ("c", 0.0, 20.0, 10.0, 30.0), ("d", 12.0, 12.0, 13.0, 13.0)], "t string, west double, south double, east double, north double")
    rings = {
        "around": [(-5, -5), (50, -5), (50, 50), (-5, 50)], "inside": [(2, 2), (3, 2), (3, 3)], "corner": [(10, 10), (11, 10), (11, 11)], "edge": [(5, 10), (6, 12), (4, 12)],
        "notch": [(-1, -1), (11, -1), (11, 11), (14, 11), (14, 14), (11, 14), (5, 10.5), (-1, 40)], "bounds only": [(-40, 9), (11, 45), (-40, 45)], "far": [(90, 90), (91, 90), (91, 91)],
    }
    rows = [(k, [tuple(map(float, p)) for p in [*r, r[0]]]) for k, r in rings.items()]
    aoi = spark.createDataFrame(rows, "p string, ring array<struct<x:double,y:double>>")
    got = {(r.p, r.t) for r in joins.polygon_pairs(tiles, "t", aoi, "p", "ring", 7.0).collect()}
    assert got == {("around", t) for t in "abcd"} | {("inside", "a"), ("corner", "a"), ("edge", "a"), ("notch", "a"), ("notch", "c"), ("notch", "d")}


def test_exact_percentiles(spark, monkeypatch):
    import numpy as np

    from pixelloom.operators import classify

    monkeypatch.setattr(classify, "BINS", 7)
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(size=500), [5.0] * 300, [1e9, -1e9]])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    shares = (0.0, 0.02, 0.37, 0.5, 0.98, 1.0)
    assert np.allclose(classify.exact_percentiles(df, "v", shares), np.quantile(v, shares), rtol=0, atol=1e-12)
    assert classify.exact_percentiles(df.where("v IS NULL"), "v", shares) is None
    assert classify.percentile_stretch(df.where("v = 5 OR v IS NULL"), ["v"]).where("v IS NOT NULL").count() == 0


def test_counts_of_null_groups_and_lists(spark):
    from pyspark.sql import functions as F

    from pixelloom.functions import text
    from pixelloom.operators import jobs

    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert sorted((str(r.k), r.n) for r in jobs.with_count(df, F.col("k"), "n").collect()) == [("None", 2), ("None", 2), ("a", 2), ("a", 2), ("b", 1)]
    raw = spark.createDataFrame([("['l'Orme', 'b c']",), ('["l\'Orme"]',), ("x, y",), ("[]",), ('["a\'", "b"]',)], "s string")
    assert [r[0] for r in raw.select(text.parse_list(F.col("s"))).collect()] == [["l'Orme", "b c"], ["l'Orme"], ["x", "y"], [], ["a'", "b"]]


@pytest.mark.parametrize("period", temporal.PERIODS)
def test_calendar_and_densify_equal_days_one_by_one(spark, period):
    start, stop = "1999-11-14", "2001-03-03"
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.date_sub(F.to_date(F.lit(stop)), 1))).alias("d"))
    want = [r.t for r in days.select(temporal.period_start(F.col("d"), period).alias("t")).distinct().orderBy("t").collect()]
    assert temporal.calendar(start, stop, period) == want
    rows = [(1, 1, want[i], float(i), "k") for i in {0, 1, 3 % len(want), len(want) - 1}] + [(2, 1, want[0], 7.0, None), (2, 1, want[0], 8.0, None), (3, 1, None, 1.0, "x"), (3, 1, dt.date(1990, 1, 1), 1.0, "x")]
    df = spark.createDataFrame(rows, "x int, y int, t date, b double, note string")
    every = {(x, 1, d): [] for x in (1, 2, 3) for d in want}
    for x, y, d, b, note in rows:
        if (x, y, d) in every:
            every[x, y, d].append((b, note))
    got = sorted(((r.x, r.y, r.t, r.b, r.note) for r in temporal.densify(df, start, stop, period).collect()), key=str)
    assert got == sorted(((*k, *v) for k, vs in every.items() for v in vs or [(None, None)]), key=str)


def test_interpolation_is_one_shuffle_and_keeps_other_columns(spark):
    rows = [(1, 1, i, None if i % 3 else float(i * i), None if i < 2 else float(i), str(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "x int, y int, t int, a double, b double, note string")
    out = temporal.interpolate(df, ["a", "b"])
    assert [(r.t, r.a, r.b, r.note) for r in out.orderBy("t").collect()] == [(i, float(np.interp(i, [0, 3, 6, 9], [0, 9, 36, 81])), None if i < 2 else float(i), str(i)) for i in range(10)]
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert out.columns == df.columns and temporal.interpolate(df.where("false"), ["a"]).count() == 0
    alone = temporal.interpolate(df.withColumn("a", F.lit(None).cast("double")), ["a"])
    assert alone.where("a IS NOT NULL").count() == 0 and alone.count() == 10


@pytest.mark.parametrize("extra", [[], [float("inf")], [float("-inf"), float("nan")], [None, float("nan")]])
@pytest.mark.parametrize("finite", [[1.0, 2.0, 3.0], [5e-324, 0.0, -5e-324, 1e-323], [-1.7e308, 1.7e308, 0.0, 3.0], [7.0] * 5, [10.0**i for i in range(-300, 300, 7)], [i % 97 / 7 for i in range(4000)]])
def test_percentiles_end_and_are_exact(spark, finite, extra):
    df = spark.createDataFrame([(v, v if i % 2 else None) for i, v in enumerate([*finite, *extra])], "a double, b double")
    shares = (0.0, 0.02, 0.5, 0.98, 1.0)
    got = classify.exact_percentiles_of(df, ["a", "b"], shares)
    for band, values in (("a", finite), ("b", [v for i, v in enumerate([*finite, *extra]) if i % 2 and v is not None and np.isfinite(v)])):
        ordered, want = sorted(values), []
        for p in shares:
            x = p * (len(ordered) - 1)
            lo, hi = ordered[int(x)], ordered[min(int(x) + 1, len(ordered) - 1)]
            want.append(lo + (hi - lo) * (x - int(x)) if x > int(x) else lo)
        assert got[band] == want


def test_percentiles_take_two_scans(spark):
    df = spark.range(100_000).select((F.col("id") % 1000).cast("double").alias("a"), (F.col("id") % 77).cast("double").alias("b"))
    jobs, group = spark.sparkContext, "percentiles-scans"
    jobs.setJobGroup(group, "count jobs")
    try:
        got = classify.exact_percentiles_of(df, ["a", "b"], (0.02, 0.98))
        assert got["a"] == pytest.approx([19.98, 979.02]) and got["b"] == [1.0, 75.0]
        assert len(jobs.statusTracker().getJobIdsForGroup(group)) <= 5  # of two scans, each in a stage before its result
    finally:
        jobs._jsc.clearJobGroup()
    none = classify.exact_percentiles_of(df.select(F.lit(float("nan")).alias("a"), "b").limit(3), ["a"], (0.5,))
    assert none == {"a": None}
    out = classify.percentile_stretch(spark.createDataFrame([(1, 1.0), (2, 3.0), (3, float("inf")), (4, float("nan")), (5, None)], "x int, a double"), ["a"], 0.0, 1.0)
    assert [r.a for r in out.orderBy("x").collect()] == [0.0, 1.0, 1.0, None, None]


def test_null_classes_mask_nothing(spark):
    cells = spark.createDataFrame([(0, 0, None), (20, 0, 4), (30, 0, 4), (100, 0, 4), (200, 0, 9)], "x int, y int, scl int")
    got = {r.x: r.mask for r in spatial.two_mask(cells, "scl", pixel.SCL_KEEP, pixel.SCL_CLOUDY).collect()}
    assert got == {0: False, 20: False, 30: False, 100: False, 200: True}


@pytest.mark.parametrize("radius", [0, 1, 3, 9])
def test_disks_over_gaps_equal_all_pairs(spark, radius):
    cells = [(x, y, k, (x * 5 + y * 3 + k) % 7 < 2 or x in (20, 21, 22)) for k in (1, 2) for x in range(-5, 30) for y in range(25) if (x * x + 3 * y + k) % 5]
    df = spark.createDataFrame(cells, "x int, y int, k int, f boolean")
    near = lambda a, b: a[2] == b[2] and (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= radius**2
    grown = {a[:3]: any(b[3] and near(a, b) for b in cells) for a in cells}
    shrunk = {a[:3]: all(b[3] or not near(a, b) for b in cells) for a in cells}
    assert {(r.x, r.y, r.k): r.f for r in spatial.dilate_disk(df, "f", radius, ["k"]).collect()} == grown
    assert {(r.x, r.y, r.k): r.f for r in spatial.erode_disk(df, "f", radius, ["k"]).collect()} == shrunk


def test_tiles_cover_a_cell_without_the_narrowest_gap(spark):
    box = "west double, south double, east double, north double"
    cell = spark.createDataFrame([("c", 0.0, 0.0, 100.0, 100.0)], f"name string, {box}")
    a, b, c, whole = ("A", -10.0, -10.0, 49.9, 110.0), ("B", 50.1, -10.0, 120.0, 110.0), ("C", 40.0, -5.0, 60.0, 105.0), ("W", -1.0, -1.0, 101.0, 101.0)
    quarters = [(f"Q{i}{j}", i * 50.0, j * 50.0, i * 50.0 + 50, j * 50.0 + 50) for i in (0, 1) for j in (0, 1)]

    def assigned(*tiles):
        out = grids.assign_tiles(cell, spark.createDataFrame(list(tiles), f"tile string, {box}"), 200.0).collect()
        return [(r.match_type, r.tiles) for r in out]

    assert assigned(a, b) == [("all", "A,B")]  # a lattice of points doesn't see the gap
    assert assigned(a, b, c) == [("triple", "A,B,C")]
    assert assigned(a, b, c, whole) == [("single", "W")]
    assert assigned(*quarters) == [("quad", "Q00,Q01,Q10,Q11")]
    assert assigned(a, ("B2", 49.0, -1.0, 100.0, 100.0), *quarters) == [("pair", "A,B2")]
    assert assigned(("F", 500.0, 500.0, 600.0, 600.0)) == []


def test_masks_deal_pixels_once(spark):
    """Work and shuffle are the pixels and their halo: no row for each row of a disk or square; chunks and their seams make no difference."""
    import random

    from pixelloom.operators import spatial

    random.seed(5)
    seams = [v + d for v in (-256, 256, 768) for d in range(-30, 31)]
    cells = {(random.choice(seams), random.choice(seams), t): random.randrange(12) for t in (1, 2) for _ in range(700)}
    df = spark.createDataFrame([(*c, s) for c, s in cells.items()] + [(None, 5, 1, 9)], "x int, y int, t int, scl int")
    near = lambda a, b, r: a[2] == b[2] and (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= r * r
    square = lambda a, b, k: a[2] == b[2] and max(abs(a[0] - b[0]), abs(a[1] - b[1])) <= k // 2
    eroded = lambda f: [c for c in cells if all(f(cells[b]) for b in cells if near(b, c, 3))]
    bad, outside, cloudy = (eroded(lambda s, k=k: s in k) for k in (pixel.SCL_BAD, set(range(12)) - {*pixel.SCL_KEEP}, pixel.SCL_CLOUDY))
    satio = spatial.satio_mask(df, ["t"])
    two = spatial.two_mask(df, "scl", pixel.SCL_KEEP, pixel.SCL_CLOUDY, keys=["t"])
    place = lambda r: (r.x, r.y, r.t)
    assert {place(r): r.mask for r in satio.collect()} == {c: any(near(c, b, 21) for b in bad) for c in cells} | {(None, 5, 1): False}
    assert {place(r): r.mask for r in two.collect()} == {c: any(square(c, b, 17) for b in outside) or any(square(c, b, 77) for b in cloudy) for c in cells} | {(None, 5, 1): False}
    for df in (satio, two):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression") == 1 and not any(step in plan for step in ("Window", "Aggregate", "Join"))


def test_segments_are_worked_out_by_all_cores(spark):
    from pixelloom.plans import catalog

    assert catalog.queries()["segmentize"](spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_composites_are_dealt_by_rows(spark, monkeypatch):
    """Tasks grow with the rows, whatever the session's number of shuffle partitions."""
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    for name in ("s1_cube", "ts_cube", "agg_period_week"):
        assert catalog.queries()[name](spark, SF).rdd.getNumPartitions() >= 60, name


def test_median_of_odd_values(spark):
    """Null, infinite, NaN, equal and single values, integers and odd names, against the built-in median."""
    inf, nan = float("inf"), float("nan")
    values = [[None], [None, 2.0], [1.0, 4.0], [3.0, 1.0, 2.0], [inf, 1.0], [-inf, inf, 5.0], [nan, 1.0, 2.0], [nan, nan, 1.0, None], [0.1, 0.1], [-0.0, 0.0, 7.0], [1e308, 1.7e308]]
    rows = [(i, 0, dt.datetime(2020, 1, 1 + k), v, None if v is None or v != v or abs(v) > 1e9 else int(v)) for i, vs in enumerate(values) for k, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "x int, y int, t timestamp, `B-1` double, n int")
    got = {r.x: (str(r["B-1"]), r.n) for r in temporal.composite(df, ["B-1", "n"], "year", "median").collect()}
    want = {r.x: (str(r.b), r.n) for r in df.groupBy("x").agg(F.median("`B-1`").alias("b"), F.median("n").alias("n")).collect()}
    assert got == want
