"""Pixel expressions: scaling, radar units, class and quality masks. All stay in generated code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scene classes of the Sentinel-2 classification.
SCL_BAD = (0, 1, 3, 8, 9, 10, 11)
SCL_KEEP = (2, 4, 5, 6, 7)
SCL_CLOUDY = (3, 8, 9, 10, 11)


def nan_to_null(v: Column) -> Column:
    return F.when(F.isnan(v), None).otherwise(v)


def linear_scale(v: Column, imin: float, imax: float, omin: float = 0.0, omax: float = 1.0) -> Column:
    """Clip to [imin, imax] and map to [omin, omax]; null stays null."""
    clipped = F.least(F.greatest(v.cast("double"), F.lit(float(imin))), F.lit(float(imax)))
    return F.when(v.isNotNull(), (clipped - imin) / (imax - imin) * (omax - omin) + omin)


def power_to_dn(v: Column, fill: bool = False) -> Column:
    """Linear backscatter to a 16-bit number, 83 dB above; fill gives 1 where there is none."""
    dn = F.pow(F.lit(10.0), (10 * F.log10(v) + 83) / 20)
    dn = F.coalesce(dn, F.lit(1.0)) if fill else dn
    return linear_scale(dn, 1, 65534, 1, 65534)


def dn_to_db(dn: Column) -> Column:
    return 20 * F.log10(dn) - 83


def scl_bad(scl: Column, classes: Iterable[int] = SCL_BAD) -> Column:
    return scl.isin(*classes)


def classify_udm2(clear: Column, snow: Column, shadow: Column, light_haze: Column, heavy_haze: Column, cloud: Column, confidence: Column) -> Column:
    """One class by priority: 7 cloud, 6 heavy haze, 5 light haze, 4 shadow, 3 snow, 2 unclear (confidence below 0.8), 1 clear."""
    ranked = ((cloud, 7), (heavy_haze, 6), (light_haze, 5), (shadow, 4), (snow, 3))
    out = None
    for flag, code in ranked:
        out = F.when(flag == 1, code) if out is None else out.when(flag == 1, code)
    return out.when(confidence < 0.8, 2).otherwise(1)


def udm2_valid(clear: Column, snow: Column, shadow: Column, light_haze: Column, heavy_haze: Column, cloud: Column, confidence: Column) -> Column:
    """Clear, and none of the other flags, with confidence of 0.8 or more."""
    off = [f == 0 for f in (snow, shadow, light_haze, heavy_haze, cloud)]
    out = clear == 1
    for f in off:
        out = out & f
    return out & (confidence >= 0.8)


def mask_bands(bands: Iterable[str], mask: Column) -> list[Column]:
    """Each band with null where the mask is true."""
    return [F.when(~F.coalesce(mask, F.lit(False)), F.col(b)).alias(b) for b in bands]
