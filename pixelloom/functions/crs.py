"""Map projections in closed form on WGS84 and GRS80: UTM, LAEA Europe and cylindrical equal area."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    inverse_f: float

    @property
    def f(self) -> float:
        return 1 / self.inverse_f

    @property
    def e(self) -> float:
        return math.sqrt(self.f * (2 - self.f))

    @property
    def n(self) -> float:
        return self.f / (2 - self.f)


# Fixed values of the ellipsoids and of the projections.
WGS84, GRS80 = Ellipsoid(6378137.0, 298.257223563), Ellipsoid(6378137.0, 298.257222101)
UTM_SCALE, FALSE_EAST, FALSE_NORTH = 0.9996, 500_000.0, 10_000_000.0
LAEA_LON, LAEA_LAT, LAEA_X, LAEA_Y = 10.0, 52.0, 4_321_000.0, 3_210_000.0
EQUAL_AREA_LAT = 30.0


def _krueger(n: float) -> tuple[float, list[float], list[float]]:
    """Radius and the series of the transverse Mercator projection in the third flattening, to its fourth power."""
    radius = (1 + n**2 / 4 + n**4 / 64) / (1 + n)
    forward = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    inverse = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    return radius, forward, inverse


def _conformal(t: Column, e: float) -> Column:
    """Tangent of the conformal latitude from the tangent of the latitude."""
    s = F.sinh(e * F.atanh(e * t / F.sqrt(1 + t * t)))
    return t * F.sqrt(1 + s * s) - s * F.sqrt(1 + t * t)


#: let(value, use) is use(value), with value evaluated once: keeps nested formulas from growing with every use.
Let = Callable[[Column, Callable[[Column], Column]], Column]


def inline(value: Column, use: Callable[[Column], Column]) -> Column:
    """A ``let`` within one column expression."""
    return F.transform(F.array(value), use)[0]


class Staged:
    """A ``let`` that makes every value a column of a frame: for many rows, as its steps are compiled, which lambdas aren't."""

    def __init__(self, df: DataFrame):
        self.df, self.n = df, 0

    def __call__(self, value: Column, use: Callable[[Column], Column]) -> Column:
        self.n += 1
        self.df = self.df.select("*", value.alias(f"_let{self.n}"))
        return use(F.col(f"_let{self.n}"))


def utm_struct(lon: Column, lat: Column, zone: Column, north: Column, let: Let = inline) -> Column:
    """Struct (e, n) in a UTM zone; select it before its fields are used more than once."""
    radius, series, _ = _krueger(WGS84.n)
    k = UTM_SCALE * WGS84.a * radius
    dl = F.radians(lon - (zone * 6 - 183))

    def sphere(t: Column) -> Column:
        return F.struct(F.atan2(t, F.cos(dl)).alias("xi"), F.asinh(F.sin(dl) / F.sqrt(t * t + F.cos(dl) * F.cos(dl))).alias("eta"))

    def place(s: Column) -> Column:
        xi, eta = s["xi"], s["eta"]
        x, y = eta, xi
        for j, c in enumerate(series, 1):
            x = x + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
            y = y + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        return F.struct((FALSE_EAST + k * x).alias("e"), (F.when(north, 0.0).otherwise(FALSE_NORTH) + k * y).alias("n"))

    tangent = let(F.tan(F.radians(lat)), lambda t: _conformal(t, WGS84.e))
    return let(let(tangent, sphere), place)


def to_utm(lon: Column, lat: Column, zone: Column, north: Column) -> tuple[Column, Column]:
    """(easting, northing) in a UTM zone."""
    out = utm_struct(lon, lat, zone, north)
    return out["e"], out["n"]


def lonlat_struct(easting: Column, northing: Column, zone: Column, north: Column, let: Let = inline) -> Column:
    """Struct (lon, lat) of UTM coordinates."""
    n = WGS84.n
    radius, _, series = _krueger(n)
    k = UTM_SCALE * WGS84.a * radius
    # latitude from conformal latitude, in the third flattening to its fourth power
    to_lat = [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]

    def sphere(s: Column) -> Column:
        xi, eta = s["xi"], s["eta"]
        x, y = eta, xi
        for j, c in enumerate(series, 1):
            x = x - c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
            y = y - c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        return F.struct(x.alias("x"), y.alias("y"))

    def place(s: Column) -> Column:
        lon = F.degrees(F.atan2(F.sinh(s["x"]), F.cos(s["y"]))) + (zone * 6 - 183)
        chi = F.asin(F.sin(s["y"]) / F.cosh(s["x"]))
        return F.struct(lon.alias("lon"), let(chi, lambda v: F.degrees(v + sum((c * F.sin(2 * j * v) for j, c in enumerate(to_lat, 1)), F.lit(0.0)))).alias("lat"))

    start = F.struct(((northing - F.when(north, 0.0).otherwise(FALSE_NORTH)) / k).alias("xi"), ((easting - FALSE_EAST) / k).alias("eta"))
    return let(let(start, sphere), place)


def from_utm(easting: Column, northing: Column, zone: Column, north: Column, let: Let = inline) -> tuple[Column, Column]:
    """(lon, lat) of UTM coordinates."""
    out = lonlat_struct(easting, northing, zone, north, let)
    return out["lon"], out["lat"]


def _authalic(s: Column, e: float) -> Column:
    """q of the sine of the latitude (Snyder 1987)."""
    return (1 - e * e) * (s / (1 - e * e * s * s) + F.atanh(e * s) / e)


def _q(s: float, e: float) -> float:
    return (1 - e * e) * (s / (1 - e * e * s * s) + math.atanh(e * s) / e)


def _latitude(beta: Column, e: float) -> Column:
    e2, e4, e6 = e**2, e**4, e**6
    return beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)


def _laea() -> tuple[float, float, float, float]:
    e, lat0 = GRS80.e, math.radians(LAEA_LAT)
    qp = _q(1.0, e)
    rq = GRS80.a * math.sqrt(qp / 2)
    beta0 = math.asin(_q(math.sin(lat0), e) / qp)
    d = GRS80.a * math.cos(lat0) / math.sqrt(1 - e**2 * math.sin(lat0) ** 2) / (rq * math.cos(beta0))
    return qp, rq, beta0, d


def to_laea(lon: Column, lat: Column, let: Let = inline) -> tuple[Column, Column]:
    """(x, y) on EPSG:3035."""
    qp, rq, beta0, d = _laea()
    dl = F.radians(lon - LAEA_LON)

    def place(beta: Column) -> Column:
        b = rq * F.sqrt(2 / (1 + math.sin(beta0) * F.sin(beta) + math.cos(beta0) * F.cos(beta) * F.cos(dl)))
        x = LAEA_X + b * d * F.cos(beta) * F.sin(dl)
        return F.struct(x.alias("x"), (LAEA_Y + b / d * (math.cos(beta0) * F.sin(beta) - math.sin(beta0) * F.cos(beta) * F.cos(dl))).alias("y"))

    out = let(F.asin(let(F.sin(F.radians(lat)), lambda s: _authalic(s, GRS80.e)) / qp), place)
    return out["x"], out["y"]


def from_laea(x: Column, y: Column, let: Let = inline) -> tuple[Column, Column]:
    """(lon, lat) of EPSG:3035 coordinates."""
    qp, rq, beta0, d = _laea()
    u, v = (x - LAEA_X) / d, (y - LAEA_Y) * d

    def place(rho: Column) -> Column:
        c = 2 * F.asin(rho / (2 * rq))
        beta = F.asin(F.cos(c) * math.sin(beta0) + F.coalesce(F.try_divide(v * F.sin(c) * math.cos(beta0), rho), F.lit(0.0)))
        lon = LAEA_LON + F.degrees(F.atan2(u * F.sin(c), rho * math.cos(beta0) * F.cos(c) - v * math.sin(beta0) * F.sin(c)))
        return F.struct(lon.alias("lon"), let(beta, lambda b: F.degrees(_latitude(b, GRS80.e))).alias("lat"))

    out = let(F.sqrt(u * u + v * v), place)
    return out["lon"], out["lat"]


def to_equal_area(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(x, y) on EPSG:6933, where areas are true."""
    e, s = WGS84.e, math.sin(math.radians(EQUAL_AREA_LAT))
    k0 = math.cos(math.radians(EQUAL_AREA_LAT)) / math.sqrt(1 - e**2 * s**2)
    return WGS84.a * k0 * F.radians(lon), WGS84.a * _authalic(F.sin(F.radians(lat)), e) / (2 * k0)


def bbox_area_km2(west: Column, south: Column, east: Column, north: Column, lonlat: bool = False) -> Column:
    """Area of a box: planar, or of degrees by way of the equal-area projection."""
    if lonlat:
        (west, south), (east, north) = to_equal_area(west, south), to_equal_area(east, north)
    return (east - west) * (north - south) / 1e6


def reproject_bbox(west: Column, south: Column, east: Column, north: Column, buffer: float = 0.0, zone: Column | None = None, northern: Column | None = None) -> dict[str, Column]:
    """An EPSG:3035 box, or with zone a UTM one, as lon/lat bounds through its two opposite corners, widened by buffer degrees."""
    back = from_laea if zone is None else lambda x, y: from_utm(x, y, zone, northern)
    (w, s), (e, n) = back(west, south), back(east, north)
    return {"west": w - buffer, "south": s - buffer, "east": e + buffer, "north": n + buffer}
