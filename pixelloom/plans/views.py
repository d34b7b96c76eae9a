"""Cube-shaped views over the test tables, and their SQL text for oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_GRID = {"x": "CAST(p_partkey % 40 AS INT)", "y": "CAST(floor(p_partkey / 40.0) AS INT)"}

#: View to (table, column expressions) in SQL that Spark and DuckDB share; [i] is an index from 0, [[i]] in DuckDB from 1.
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "obs_long": ("events", {
        "obs_id": "event_id", "x": "CAST(user_id % 16 AS INT)", "y": "CAST(floor(user_id / 16.0) AS INT)", "t": "CAST(ts AS TIMESTAMP)", "band": "event_type",
        "value": "value", "scl": "CAST(event_id % 12 AS INT)", "cloud_cover": "CAST((event_id * 7) % 101 AS INT)",
        "orbit_state": "CASE WHEN event_id % 3 = 0 THEN 'ASCENDING' ELSE 'DESCENDING' END",
    }),
    "refl_wide": ("lineitem", {
        "x": "CAST(l_partkey % 40 AS INT)", "y": "CAST(floor(l_partkey / 40.0) AS INT)", "t": "l_shipdate",
        "B02": "l_quantity * 40 + 100", "B03": "l_quantity * 50 + 200", "B04": "l_quantity * 60 + 300", "B05": "l_quantity * 70 + l_tax * 1000",
        "B06": "l_extendedprice / 30 + 400", "B07": "l_extendedprice / 25 + 500", "B08": "l_extendedprice / 12 + 600", "B8A": "l_extendedprice / 13 + 600",
        "B11": "l_quantity * 90 + l_discount * 5000", "B12": "l_quantity * 45 + l_discount * 8000", "VV": "(l_discount + 0.01) * 1.5", "VH": "(l_tax + 0.005) * 0.5",
        "scl": "CAST((l_orderkey + l_linenumber) % 12 AS INT)", "cloud_cover": "CAST((l_orderkey * 3) % 101 AS INT)",
        "s2_tile": "concat('31U', substring('EFG', CAST(l_suppkey % 3 AS INT) + 1, 1), 'S')",
    }),
    "scl_raster": ("part", {**_GRID, "scl": "CAST(p_size % 12 AS INT)"}),
    "static_cube": ("part", {**_GRID, "dem": "p_retailprice", "soc": "CAST(p_size AS DOUBLE)"}),
    "ref_points": ("customer", {
        "point_id": "c_custkey", "lon": "CAST((c_custkey * 3761) % 36000 AS DOUBLE) / 100 - 180", "lat": "CAST((c_custkey * 2953) % 16400 AS DOUBLE) / 100 - 80",
        "label": "c_mktsegment", "easting": "CAST(166000 + (c_custkey * 7919) % 668000 AS DOUBLE)", "northing": "CAST((c_custkey * 104729) % 9300000 AS DOUBLE)",
        "zone_number": "CAST(c_custkey % 60 + 1 AS INT)", "zone_letter": "CASE WHEN c_custkey % 2 = 0 THEN 'N' ELSE 'M' END",
    }),
    "aoi_boxes": ("supplier", {
        "aoi_id": "s_suppkey", "aoi_name": "s_name", "west": "CAST(900000 + (s_suppkey * 613000) % 7000000 AS DOUBLE)", "south": "CAST(800000 + (s_suppkey * 389000) % 6600000 AS DOUBLE)",
        "east": "CAST(1050000 + (s_suppkey * 613000) % 7000000 AS DOUBLE)", "north": "CAST(890000 + (s_suppkey * 389000) % 6600000 AS DOUBLE)",
    }),
    "laea_tiles": ("customer", {"name": "concat('E', lpad(CAST(9 + c_custkey % 72 AS VARCHAR(8)), 2, '0'), 'N', lpad(CAST(8 + (c_custkey * 5) % 68 AS VARCHAR(8)), 2, '0'))"}),
    "job_tracker": ("orders", {
        "id": "o_orderkey", "status": "CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'running' ELSE 'error' END",
        "previous_status": "CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'queued' WHEN 1 THEN 'running' WHEN 2 THEN 'downloading' ELSE 'created' END",
        "attempt": "CAST(o_orderkey % 6 AS INT)", "cost": "o_totalprice / 1000",
        "log_text": "CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN 'exit code: 50' WHEN 1 THEN 'NoDataAvailable' WHEN 2 THEN 'Orfeo toolbox.' WHEN 3 THEN 'No tiff for band VH' WHEN 4 THEN 'sar_backscatter: No tiffs found in x' ELSE 'other' END",
        "start_time": "o_orderdate", "tile_id": "CAST(o_custkey % 50 AS INT)",
    }),
    "class_probs": ("embeddings", {
        "vec_id": "vec_id", "x": "CAST(vec_id % 25 AS INT)", "y": "CAST(floor(vec_id / 25.0) AS INT)",
        "p1": "abs(CAST(embedding[[0]] AS DOUBLE))", "p2": "abs(CAST(embedding[[1]] AS DOUBLE))", "p3": "abs(CAST(embedding[[2]] AS DOUBLE))",
    }),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a lazy frame: a projection of one table."""
    table, columns = VIEWS[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    out = df.selectExpr(*[f"{e.replace('[[', '[').replace(']]', ']')} AS {c}" for c, e in columns.items()])
    return out.distinct() if name == "laea_tiles" else out


def sql(name: str) -> str:
    """The view as a DuckDB common table expression."""
    import re

    table, columns = VIEWS[name]
    body = ", ".join(f"{re.sub(r'\[\[(\d+)\]\]', lambda m: f'[{int(m[1]) + 1}]', e)} AS {c}" for c, e in columns.items())
    return f"{name} AS (SELECT {'DISTINCT ' if name == 'laea_tiles' else ''}{body} FROM {table})"
