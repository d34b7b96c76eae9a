"""Grid identifiers: UTM zones, MGRS letters, 100 km and 20 km cells, LAEA tile extents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the military grid reference system.
BANDS = "CDEFGHJKLMNPQRSTUVWXX"
COLUMNS = ("ABCDEFGH", "JKLMNPQR", "STUVWXYZ")
ROWS = ("ABCDEFGHJKLMNPQRSTUV", "FGHJKLMNPQRSTUVABCDE")
# Letters per 2,000 km of northing, north and south of the equator.
NORTH, SOUTH = "λπστφ", "αßΓδε"


def _pick(letters: str, at: Column) -> Column:
    """The letter at index at (from 0); null outside."""
    return F.when((at >= 0) & (at < len(letters)), F.substring(F.lit(letters), (at + 1).cast("int"), F.lit(1)))


def zone_letter(lat: Column) -> Column:
    inside = (lat >= -80) & (lat <= 84)
    return F.when(inside, _pick(BANDS, F.floor((lat + 80) / 8)))


def zone_number(lon: Column, lat: Column) -> Column:
    """Six-degree zones, with the exceptions of south Norway and Svalbard."""
    plain = (F.floor((lon + 180) / 6) % 60 + 1).cast("int")
    norway = (lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12)
    svalbard = (lat >= 72) & (lat <= 84) & (lon >= 0) & (lon < 42)
    return F.when(norway, 32).when(svalbard, F.when(lon < 9, 31).when(lon < 21, 33).when(lon < 33, 35).otherwise(37)).otherwise(plain)


def utm_epsg(zone: Column, north: Column) -> Column:
    return F.when(north, 32600 + zone).otherwise(32700 + zone).cast("int")


def column_letter(zone: Column, easting: Column) -> Column:
    at = F.floor(easting / 100000) - 1
    out = None
    for i, letters in enumerate(COLUMNS):
        hit = (zone - 1) % 3 == i
        out = F.when(hit, _pick(letters, at)) if out is None else out.when(hit, _pick(letters, at))
    return out


def row_letter(zone: Column, northing: Column) -> Column:
    at = F.floor(northing / 100000) % 20
    return F.when((zone - 1) % 2 == 0, _pick(ROWS[0], at)).otherwise(_pick(ROWS[1], at))


def mgrs_100k(zone: Column, easting: Column, northing: Column) -> Column:
    return F.concat(column_letter(zone, easting), row_letter(zone, northing))


def greek_letter(northing: Column, north: Column) -> Column:
    at = F.floor(northing / 2_000_000)
    return F.when(north, _pick(NORTH, at)).otherwise(_pick(SOUTH, at))


def mgrs_id(zone: Column, letter: Column, easting: Column, northing: Column) -> Column:
    return F.concat(F.lpad(zone.cast("string"), 2, "0"), letter, mgrs_100k(zone, easting, northing))


def mgrs_metres(zone: Column, letter: Column, easting: Column, northing: Column, digits: int) -> Column:
    """MGRS id with so many digits for each axis: 4 for 10 m, 5 for 1 m, truncated."""
    unit = 10 ** (5 - digits)
    part = lambda v: F.lpad(F.floor((v % 100000) / unit).cast("string"), digits, "0")
    return F.concat(mgrs_id(zone, letter, easting, northing), part(easting), part(northing))


def grid100_id(zone: Column, north: Column, easting: Column, northing: Column) -> Column:
    return F.concat(F.lpad(zone.cast("string"), 2, "0"), greek_letter(northing, north), mgrs_100k(zone, easting, northing))


def grid20_id(zone: Column, north: Column, easting: Column, northing: Column) -> Column:
    cell = lambda v: F.floor((v % 100000) / 20000).cast("string")
    return F.concat(grid100_id(zone, north, easting, northing), cell(easting), cell(northing))


def grid_epsg(grid_id: Column) -> Column:
    """EPSG code from a 100 km or 20 km id: the third letter tells the hemisphere."""
    return utm_epsg(F.substring(grid_id, 1, 2).cast("int"), F.substring(grid_id, 3, 1) > "ε")


def mgrs_epsg(mgrs: Column) -> Column:
    return utm_epsg(F.substring(mgrs, 1, 2).cast("int"), F.substring(mgrs, 3, 1) >= "N")


def pixel_centre(v: Column, res: float) -> Column:
    return F.floor(v / res) * res + res / 2


def laea_extent(name: Column, size_km: int) -> dict[str, Column]:
    """west, south, east, north in metres of a tile id E..N.. on the 3035 grid; the digits count 100 km, or 10 km in longer ids."""
    part = lambda axis: F.regexp_extract(name, f"{axis}(\\d+)", 1)
    metres = lambda s: s.cast("long") * F.when(F.length(s) == 2, 100_000).otherwise(10_000)
    w, s = metres(part("E")), metres(part("N"))
    return {"west": w, "south": s, "east": w + size_km * 1000, "north": s + size_km * 1000}


def parent_100km(name: Column) -> Column:
    """100 km id of a 20 km tile id such as E480N282."""
    return F.concat(F.substring(name, 1, 3), F.substring(name, 5, 3))
