"""Optical and radar indices as column expressions over reflectances in 0 to 1."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common band names of the sensors.
SENTINEL2 = {"B": "B02", "G": "B03", "R": "B04", "RE1": "B05", "RE2": "B06", "RE3": "B07", "N": "B08", "S1": "B11", "S2": "B12"}
PLANET = {"B": "B02", "G": "B04", "R": "B06", "RE1": "B07", "N": "B08"}

Bands = Mapping[str, Column]


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def normalised(a: Column, b: Column) -> Column:
    return ratio(a - b, a + b)


def ndvi(b: Bands) -> Column:
    return normalised(b["N"], b["R"])


def mndwi(b: Bands) -> Column:
    return normalised(b["G"], b["S1"])


def avi(b: Bands) -> Column:
    p = b["N"] * (1 - b["R"]) * (b["N"] - b["R"])
    return F.when(p >= 0, F.pow(p, F.lit(1 / 3)))


def blfei(b: Bands) -> Column:
    mean = (b["G"] + b["R"] + b["S2"]) / 3
    return normalised(mean, b["S1"])


OPTICAL: dict[str, Callable[[Bands], Column]] = {
    "NDVI": ndvi,
    "AVI": avi,
    "CIRE": lambda b: ratio(b["N"], b["RE1"]) - 1,
    "NIRv": lambda b: ndvi(b) * b["N"],
    "NDMI": lambda b: normalised(b["N"], b["S1"]),
    "NDWI": lambda b: normalised(b["G"], b["N"]),
    "BLFEI": blfei,
    "MNDWI": mndwi,
    "NDVIMNDWI": lambda b: ndvi(b) - mndwi(b),
    "S2WI": lambda b: normalised(b["RE1"], b["S2"]),
    "S2REP": lambda b: 705 + 35 * ratio((b["RE3"] + b["R"]) / 2 - b["RE1"], b["RE2"] - b["RE1"]),
    "IRECI": lambda b: ratio(b["RE3"] - b["R"], ratio(b["RE1"], b["RE2"])),
}
PLANET_LIST = ("NDVI", "AVI", "CIRE", "NIRv", "NDWI")

RADAR: dict[str, Callable[[Column, Column], Column]] = {
    "RVI": lambda vv, vh: ratio(4 * vh, vv + vh),
    "VHVVD": lambda vv, vh: vh - vv,
    "VHVVR": lambda vv, vh: ratio(vh, vv),
}


def optical(names: list[str] | None = None, bands: Mapping[str, str] = SENTINEL2, scale: float | None = None) -> list[Column]:
    """Columns for the named indices; scale divides and clips the reflectances first (10000 for scaled integers)."""
    from pixelloom.functions.pixel import linear_scale

    read = {k: linear_scale(F.col(c), 0, scale) if scale else F.col(c) for k, c in bands.items()}
    return [OPTICAL[n](read).alias(n) for n in names or OPTICAL]


def radar(names: list[str] | None = None, vv: str = "VV", vh: str = "VH") -> list[Column]:
    return [RADAR[n](F.col(vv), F.col(vh)).alias(n) for n in names or RADAR]
