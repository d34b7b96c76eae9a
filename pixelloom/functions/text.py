"""Parsing of columns that hold lists, boxes and names as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_list(text: Column) -> Column:
    """A JSON or Python list of strings, else a comma-separated string, as an array."""
    own = F.regexp_replace(text, r"(?<=[\[,]\s{0,9})'|'(?=\s*[\],])", '"')  # quotes at the ends of items, not apostrophes in them
    as_json = F.coalesce(F.from_json(text, "array<string>"), F.from_json(own, "array<string>"))
    return F.when(F.trim(text).startswith("["), as_json).otherwise(F.transform(F.split(text, ","), lambda x: F.trim(x)))


def parse_bbox(text: Column, crs: int | None = None) -> Column:
    """A box written as a Python dict or JSON, as a struct; crs replaces its own."""
    box = F.from_json(F.regexp_replace(text, "'", '"'), "west double, south double, east double, north double, crs int")
    return box.withField("crs", F.lit(crs)) if crs else box


def feature_list(text: Column) -> Column:
    """Names of a quoted, comma-separated list."""
    return F.transform(F.split(F.regexp_replace(text, '^"+|"+$', ""), ","), lambda x: F.trim(x))


def unique_id(day: Column, seed: Column, length: int = 40) -> Column:
    """yyyymmdd and a hyphenated hash of the seed, cut to length (25 to 88)."""
    if not 25 <= length <= 88:
        raise ValueError("length must be 25 to 88")
    code = F.regexp_replace(F.sha2(seed.cast("string"), 256), "(.{6})", "$1-")
    return F.substring(F.concat(F.date_format(day, "yyyyMMdd"), F.lit("-"), code), 1, length)


def metadata_map(key: Column, value: Column) -> Column:
    """Aggregate: the key-value metadata of a file as one map."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))


def metadata_field(metadata: Column, key: str, schema: str) -> Column:
    """A JSON value of such a map, parsed; null if there is none."""
    return F.from_json(F.try_element_at(metadata, F.lit(key)), schema)
