"""Options and the cube pipelines: Sentinel-1, Sentinel-2, Planet and their merge, as one lazy plan each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelloom.functions import indices, pixel
from pixelloom.operators import joins, spatial, temporal
from pixelloom.operators.warp import Grid, warp

S1_BANDS, S2_BANDS = ("VV", "VH"), ("B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B11", "B12")
# Feature bands without meaning.
MEANINGLESS = (
    "S2REP_sd", "S2REP_sum", "S2REP_iqr", "VV_sum", "VH_sum", "VHVVD_sum", *(f"S2-CLOUD-MASK_{s}" for s in temporal.FEATURES),
)


@dataclass(frozen=True)
class CubeOptions:
    """Validated once, on the driver."""

    ts_interval: str | None = "dekad"
    time_interpolation: bool = False
    s1_reducer: str = "mean"
    s2_reducer: str = "median"
    s1_orbit: str | None = None
    max_cloud_cover: int = 95
    masking: str | None = "satio"
    erode: int = 3
    dilate: int = 21
    apply_cloud_mask: bool = True
    s2_tiles: tuple[str, ...] = ()
    optical: tuple[str, ...] = tuple(indices.OPTICAL)
    radar: tuple[str, ...] = tuple(indices.RADAR)
    append: bool = True
    s1_db: bool = True
    source_grid: Grid | None = None
    target_grid: Grid | None = None

    def __post_init__(self):
        if (self.source_grid is None) != (self.target_grid is None):
            raise ValueError("source_grid and target_grid go together")
        if self.ts_interval not in (*temporal.PERIODS, "P1M", None):
            raise ValueError(f"ts_interval must be one of {temporal.PERIODS} or None")
        for r in (self.s1_reducer, self.s2_reducer):
            if r not in temporal.reducers():
                raise ValueError(f"unknown reducer {r}")
        if self.masking not in ("satio", "mask_scl_dilation", "classes", None):
            raise ValueError(f"unknown masking {self.masking}")
        if unknown := {*self.optical} - {*indices.OPTICAL} | {*self.radar} - {*indices.RADAR}:
            raise ValueError(f"unknown indices {sorted(unknown)}")
        if not 0 <= self.max_cloud_cover <= 100:
            raise ValueError("max_cloud_cover must be 0 to 100")
        if self.s1_orbit not in ("ASCENDING", "DESCENDING", None):
            raise ValueError("s1_orbit must be ASCENDING, DESCENDING or None")


#: Presets by task.
PRESETS = {"raw": CubeOptions(), "vi": CubeOptions(ts_interval="dekad", time_interpolation=True), "feature": CubeOptions(ts_interval="dekad", append=True)}


def options(task: str = "feature", **changes) -> CubeOptions:
    if task not in PRESETS:
        raise ValueError(f"task must be one of {sorted(PRESETS)}")
    return replace(PRESETS[task], **changes)


def filter_tiles(df: DataFrame, ids: Sequence[str], column: str = "s2_tile") -> DataFrame:
    """One id: equality, or a pattern if it has *; several: membership; none: all."""
    if not ids:
        return df
    if len(ids) == 1:
        return df.where(F.col(column).like(ids[0].replace("*", "%")) if "*" in ids[0] else F.col(column) == ids[0])
    return df.where(F.col(column).isin(*ids))


def load(
    df: DataFrame, bands: Sequence[str], start: str | None = None, stop: str | None = None, bbox: tuple[int, int, int, int] | None = None,
    max_cloud_cover: int | None = None, orbit: str | None = None, tiles: Sequence[str] = (), keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of [start, stop) and of the pixel box (west, south, east, north; inclusive), with the properties asked for; only these columns."""
    if start:
        df = df.where(F.col("t") >= F.lit(start).cast("timestamp"))
    if stop:
        df = df.where(F.col("t") < F.lit(stop).cast("timestamp"))
    if bbox:
        df = df.where(F.col("x").between(bbox[0], bbox[2]) & F.col("y").between(bbox[1], bbox[3]))
    if max_cloud_cover is not None:
        df = df.where(F.col("cloud_cover") <= max_cloud_cover)
    if orbit:
        df = df.where(F.col("orbit_state") == orbit)
    return filter_tiles(df, tiles).select("x", "y", "t", *keep, *bands)


def placed(cube: DataFrame, bands: Sequence[str], opt: CubeOptions) -> DataFrame:
    """The cube on the target grid of the options, if there is one: nearest neighbours, before anything else is done."""
    return warp(cube, bands, opt.source_grid, opt.target_grid, block=16) if opt.target_grid else cube


def s1_cube(df: DataFrame, opt: CubeOptions) -> DataFrame:
    """Backscatter as 16-bit numbers: composite, interpolate, scale."""
    cube = placed(load(df, S1_BANDS, orbit=opt.s1_orbit), S1_BANDS, opt)
    if opt.ts_interval:
        cube = temporal.composite(cube, S1_BANDS, opt.ts_interval, opt.s1_reducer, by_pixel=True, tasks=joins.by_rows(df))
    if opt.time_interpolation:
        cube = temporal.interpolate(cube, S1_BANDS)
    return cube.select("x", "y", "t", *[pixel.power_to_dn(F.col(b)).alias(b) for b in S1_BANDS])


def cloud_mask(scenes: DataFrame, opt: CubeOptions) -> DataFrame:
    """(x, y, t, mask) of scenes with column scl."""
    rows = scenes.select("x", "y", "t", "scl")
    if opt.masking == "satio":
        return spatial.satio_mask(rows, ("t",), opt.erode, opt.dilate)
    if opt.masking == "mask_scl_dilation":
        return spatial.two_mask(rows, "scl", pixel.SCL_KEEP, pixel.SCL_CLOUDY, keys=("t",))
    return rows.select("x", "y", "t", F.coalesce(pixel.scl_bad(F.col("scl")), F.lit(False)).alias("mask"))


def s2_cube(df: DataFrame, opt: CubeOptions, bands: Sequence[str] = S2_BANDS) -> DataFrame:
    """Reflectances in 0 to 65534: cloud filter, mask, composite, interpolate. Rows of a pixel and time are reduced together."""
    cube = load(df, bands, max_cloud_cover=opt.max_cloud_cover, tiles=opt.s2_tiles, keep=("scl",))
    cube = placed(cube, ["scl", *bands], opt)
    if opt.masking == "classes":
        cube = cube.select("x", "y", "t", *pixel.mask_bands(bands, pixel.scl_bad(F.col("scl"))))
    elif opt.masking:
        cube = cube.repartition("x", "y")  # the one shuffle of the bands: for the mask, the composite and what follows
        scenes = cube.groupBy("x", "y", "t").agg(F.max("scl").alias("scl"))
        mask = cloud_mask(scenes, opt).repartition("x", "y").hint("merge")  # as long as the cube, whatever its estimate
        if opt.apply_cloud_mask:
            cube = spatial.apply_mask(cube.drop("scl"), mask, bands, ("x", "y", "t"))
        else:
            cube = spatial.mask_as_band(cube.drop("scl"), mask.withColumn("mask", F.col("mask").cast("int")), on=("x", "y", "t"))
            bands = [*bands, "S2-CLOUD-MASK"]
    if opt.ts_interval:
        cube = temporal.composite(cube, bands, opt.ts_interval, opt.s2_reducer, by_pixel=True, dealt=opt.masking not in ("classes", None), tasks=joins.by_rows(df))
    if opt.time_interpolation:
        cube = temporal.interpolate(cube, bands)
    return cube.select("x", "y", "t", *[pixel.linear_scale(F.col(b), 0, 65534, 0, 65534).alias(b) for b in bands])


def planet_cube(df: DataFrame, bands: Sequence[str], period: str = "dekad", reducer: str = "median") -> DataFrame:
    """Reflectances masked by their quality class (column udm2, keep class 1), composited and scaled."""
    cube = df.select("x", "y", "t", *pixel.mask_bands(bands, F.col("udm2") != 1))
    cube = temporal.composite(cube, bands, period, reducer)
    return cube.select("x", "y", "t", *[pixel.linear_scale(F.col(b), 0, 65534, 0, 65534).alias(b) for b in bands])


def ts_cube(s1: DataFrame, s2: DataFrame, opt: CubeOptions) -> DataFrame:
    """Sentinel-1 and Sentinel-2 bands of the same times in one cube."""
    return joins.merge_cubes(s1_cube(s1, opt), s2_cube(s2, opt), tasks=joins.by_rows(s1.select("x").unionByName(s2.select("x"))))


def s1_indices(cube: DataFrame, opt: CubeOptions) -> DataFrame:
    """Radar indices on decibels, after or instead of the bands."""
    db = cube.select("x", "y", "t", *[(pixel.dn_to_db(F.col(b)) if opt.s1_db else F.col(b)).alias(b) for b in S1_BANDS])
    return db.select("x", "y", "t", *(S1_BANDS if opt.append else ()), *indices.radar(list(opt.radar)))


def s2_indices(cube: DataFrame, opt: CubeOptions) -> DataFrame:
    """Optical indices on reflectances in 0 to 1, after or instead of the bands; all in one projection."""
    extra = [c for c in cube.columns if c == "S2-CLOUD-MASK"]
    return cube.select("x", "y", "t", *(S2_BANDS if opt.append else ()), *indices.optical(list(opt.optical), scale=10_000), *[F.col(f"`{c}`") for c in extra])


def planet_indices(cube: DataFrame, names: Sequence[str] = indices.PLANET_LIST) -> DataFrame:
    return cube.select("x", "y", "t", *indices.optical(list(names), indices.PLANET, scale=10_000))


def features(cube: DataFrame) -> DataFrame:
    """Nine statistics of every band, without the meaningless ones."""
    bands = [c for c in cube.columns if c not in ("x", "y", "t")]
    out = temporal.temporal_features(cube, bands)
    return out.drop(*MEANINGLESS)


def s1_features(df: DataFrame, opt: CubeOptions) -> DataFrame:
    return features(s1_indices(s1_cube(df, opt), opt))


def s2_features(df: DataFrame, opt: CubeOptions) -> DataFrame:
    return features(s2_indices(s2_cube(df, opt), opt))


def planet_features(df: DataFrame, bands: Sequence[str]) -> DataFrame:
    return features(planet_indices(planet_cube(df, bands)))


def master_indices(s1: DataFrame, s2: DataFrame, opt: CubeOptions) -> DataFrame:
    tasks = joins.by_rows(s1.select("x").unionByName(s2.select("x")))
    return joins.merge_cubes(s1_indices(s1_cube(s1, opt), opt), s2_indices(s2_cube(s2, opt), opt), tasks=tasks)


def master_features(s1: DataFrame, s2: DataFrame, opt: CubeOptions) -> DataFrame:
    """Features of both sensors: each is reduced over time first, so only one row for each pixel is joined."""
    return joins.merge_static(s1_features(s1, opt), s2_features(s2, opt), "full_outer")


def check_bands(df: DataFrame, bands: Sequence[str]) -> None:
    if missing := [b for b in bands if b not in df.columns]:
        raise ValueError(f"missing bands {missing}")


def feature_names(result: DataFrame, source: DataFrame) -> list[str]:
    """Columns that a result adds to its source."""
    return [c for c in result.columns if c not in source.columns]
