"""File and database sources and sinks, all through Spark's readers and writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.operators.polygons import rings_of

GEOJSON = "type string, features array<struct<type:string, id:string, geometry:struct<type:string, coordinates:string>, properties:map<string,string>>>"
# The kinds of a valid GeoJSON object.
GEOMETRIES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")


def read_points_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(path, id, geometry type, coordinates as JSON, rings, properties): a row for each feature of every file under path; rings of polygons only."""
    text = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    f = text.select("path", F.explode(F.from_json("value", GEOJSON)["features"]).alias("f"))
    kind, coordinates = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    return f.select("path", F.col("f.id").alias("id"), kind.alias("geometry"), coordinates.alias("coordinates"), rings_of(kind, coordinates).alias("rings"), F.col("f.properties").alias("properties"))


def is_valid_geojson(text: Column) -> Column:
    """Whether a string is a geometry, a feature, or a collection of features whose geometries are known kinds."""
    kind = F.get_json_object(text, "$.type")
    has = F.get_json_object(text, "$.coordinates").isNotNull()
    geometry = kind.isin(*GEOMETRIES) & has
    feature = (kind == "Feature") & F.get_json_object(text, "$.geometry.type").isin(*GEOMETRIES) & F.get_json_object(text, "$.geometry.coordinates").isNotNull()
    parsed = F.from_json(text, GEOJSON)["features"]
    every = F.forall(parsed, lambda f: (f["type"] == "Feature") & f["geometry"]["type"].isin(*GEOMETRIES) & f["geometry"]["coordinates"].isNotNull())
    return F.coalesce(geometry | feature | ((kind == "FeatureCollection") & parsed.isNotNull() & every), F.lit(False))


def read_grid(df: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Tiles that meet a box; plain comparisons, so Parquet statistics skip row groups."""
    return df.where((F.col("east") >= west) & (F.col("west") <= east) & (F.col("north") >= south) & (F.col("south") <= north))


def read_results(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Result files with columns united by name."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def parquet_footers(spark: SparkSession, root: str) -> DataFrame:
    """(path, n_rows, metadata) of every Parquet file under root: the rows and the key-value metadata that its footer tells; tasks read footers only."""

    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for b in batches:
            rows = []
            for path in b.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    footer = pq.read_metadata(f)
                rows.append((path, footer.num_rows, [(k.decode(), v.decode()) for k, v in (footer.metadata or {}).items()]))
            kinds = (pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["path", "n_rows", "metadata"])

    found = list_files(spark, root, ".parquet").select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"))
    return found.mapInArrow(read, "path string, n_rows long, metadata map<string,string>")


def list_files(spark: SparkSession, root: str, suffix: str = "", recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of files; contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    reader = reader.option("pathGlobFilter", f"*{suffix}") if suffix else reader
    return reader.load(root).select("path", "length", "modificationTime")


def multipart_etag(content: Column, part: int) -> Column:
    """Checksum of an object in parts of so many bytes: the MD5 of the parts' MD5s, and their number."""
    n = F.greatest(F.ceil(F.octet_length(content) / part), F.lit(1)).cast("int")
    md5s = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.unhex(F.md5(F.substring(content, (i * part + 1).cast("int"), F.lit(part)))))
    joined = F.aggregate(md5s, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))
    return F.concat(F.md5(joined), F.lit("-"), n.cast("string"))


def verify_checksums(files: DataFrame, expected: DataFrame, parts: Sequence[int]) -> DataFrame:
    """(path, etag, ok): files (path, content) against expected (path, etag): a plain MD5, or a multipart checksum of one of the part sizes."""
    both = files.join(expected, "path")
    tags = [F.md5("content"), *[multipart_etag(F.col("content"), p) for p in parts]]
    return both.select("path", "etag", F.array_contains(F.array(*tags), F.col("etag")).alias("ok"))


def load_stac(spark: SparkSession, items: DataFrame, assets: DataFrame, start: str, stop: str) -> DataFrame:
    """Asset rows of the items of a time span: items (id, datetime, assets map of band to href) joined by href."""
    wanted = items.where((F.col("datetime") >= start) & (F.col("datetime") < stop)).select("id", F.col("datetime").alias("t"), F.explode("assets").alias("band", "href"))
    return wanted.join(assets, "href")


STAC_ITEM = "id string, bbox array<double>, properties struct<datetime:timestamp>, assets map<string,struct<href:string>>"


def read_stac(spark: SparkSession, path: str, start: str | None = None, stop: str | None = None, bbox: Sequence[float] | None = None, bands: Sequence[str] = ()) -> DataFrame:
    """(id, t, band, href) of the assets of STAC items (a JSON object a line): items of [start, stop) whose box meets (west, south, east, north), assets of some bands or all."""
    items = spark.read.schema(STAC_ITEM).json(path).withColumn("t", F.col("properties.datetime"))
    if start:
        items = items.where(F.col("t") >= F.lit(start).cast("timestamp"))
    if stop:
        items = items.where(F.col("t") < F.lit(stop).cast("timestamp"))
    if bbox:
        west, south, east, north = bbox
        items = items.where((F.col("bbox")[0] <= east) & (F.col("bbox")[2] >= west) & (F.col("bbox")[1] <= north) & (F.col("bbox")[3] >= south))
    rows = items.select("id", "t", F.explode("assets").alias("band", "asset")).select("id", "t", "band", "asset.href")
    return rows.where(F.col("band").isin(*bands)) if bands else rows


def jdbc_read(spark: SparkSession, url: str, table: str, columns: Sequence[str], fetch: int = 500_000, key: str | None = None, parts: int = 8, quote: str = '"', **options) -> DataFrame:
    """Columns of a table with a server-side cursor.

    With key, a column of whole numbers or times, the table is read by up to so many tasks, each a range of equal width
    between the bounds, which the database is asked for. Rows without a key come with the first. quote: the database's
    quotation mark for names.
    """
    if key:
        bounds = jdbc_query(spark, url, f"SELECT min({quote}{key}{quote}) AS low, max({quote}{key}{quote}) AS high FROM {table}", **options).first()
        if bounds[0] is not None:
            options |= {"partitionColumn": key, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": parts}
    return spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch, **options).load().select(*columns)


def jdbc_query(spark: SparkSession, url: str, query: str, key: str | None = None, parts: int = 8, **options) -> DataFrame:
    """Rows of a query that the database runs; with key, one of its columns, by ranges of it as jdbc_read does."""
    if key:
        return jdbc_read(spark, url, f"({query}) q", ["*"], key=key, parts=parts, **options)
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def jdbc_insert(df: DataFrame, url: str, table: str, **options) -> None:
    """Append rows; NaN becomes null."""
    floats = [c for c, k in df.dtypes if k in ("double", "float")]
    clean = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])
    clean.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def jdbc_upsert(updates: DataFrame, url: str, table: str, key: str, quote: str = '"', **options) -> None:
    """Rows of a table are updated by key (one row of updates for each) where the update isn't null; rows of other keys are added.

    Tasks append the updates to a staging table of a new name, the database merges it by one statement, and it is dropped,
    also after a failure. So readers see all of the updates or none, and a repeated call changes nothing more. Null keys
    are left out. NaN becomes null.
    """
    stage = f"STAGE_{uuid.uuid4().hex[:16].upper()}"
    name = lambda c, of="": f"{of}{quote}{c}{quote}"
    changed = [c for c in updates.columns if c != key]
    sets = ", ".join(f"{name(c)} = COALESCE({name(c, 's.')}, {name(c, 't.')})" for c in changed)
    merge = f"MERGE INTO {table} t USING {stage} s ON {name(key, 't.')} = {name(key, 's.')}"
    merge += f" WHEN MATCHED THEN UPDATE SET {sets}" if changed else ""
    merge += f" WHEN NOT MATCHED THEN INSERT ({', '.join(map(name, updates.columns))}) VALUES ({', '.join(name(c, 's.') for c in updates.columns)})"
    try:
        jdbc_insert(updates.where(F.col(key).isNotNull()), url, stage, **options)
        _run(updates.sparkSession, url, merge, options)
    finally:
        _run(updates.sparkSession, url, f"DROP TABLE {stage}", options)


def _run(spark: SparkSession, url: str, statement: str, options: dict) -> None:
    """One statement, from the driver."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for k, v in options.items():
        properties.setProperty(k, str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        todo = connection.createStatement()
        todo.executeUpdate(statement)
        todo.close()
    finally:
        connection.close()


def write_cube(df: DataFrame, path: str, partition: Sequence[str] = (), fmt: str = "parquet") -> None:
    """A cube as Parquet or CSV, a folder for each value of the partition columns; reruns replace those they write."""
    out = df.repartition(*partition) if partition else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.partitionBy(*partition) if partition else writer
    writer.option("header", "true").format(fmt).save(path)


def split_bands(df: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("x", "y", "t")) -> DataFrame:
    """Long layout (keys, band, value), for one asset a band."""
    return df.unpivot(list(keys), list(bands), "band", "value")


def persist_jobs(df: DataFrame, path: str) -> DataFrame:
    """The job table at path if there is one, else df, written there."""
    spark = df.sparkSession
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    df.write.parquet(path)
    return spark.read.parquet(path)


def read_xml_tiles(spark: SparkSession, path: str, zones: Sequence[int] = ()) -> DataFrame:
    """(tile_id, epsg, utm_wkt) of the placemarks of a tile KML, for some UTM zones or all."""
    rows = spark.read.format("xml").option("rowTag", "Placemark").schema("name string, description string").load(path)
    epsg = F.regexp_extract("description", r"(32[67]\d\d)", 1).try_cast("int")
    wkt = F.regexp_extract("description", r"((?:MULTI)?POLYGON\s*\(\(.*?\)\)\)?)", 1)
    out = rows.select(F.trim("name").alias("tile_id"), epsg.alias("epsg"), wkt.alias("utm_wkt"))
    return out.where(F.substring("tile_id", 1, 2).try_cast("int").isin(*zones)) if zones else out
