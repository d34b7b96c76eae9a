"""Neighbourhood operators on pixel tables: disk and square morphology, masks, resampling and chunks with halo."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelloom.functions.pixel import mask_bands, scl_bad


def convolve_disk(pixels: DataFrame, flag: str, radius: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, x, y, n): for every pixel of the table, how many flagged pixels lie within the disk x² + y² <= radius².

    Each flagged pixel opens a run at its left edge and closes it after its right edge in every row that its disk meets; a
    running sum along each row gives the count. Work is flagged pixels x (2 radius + 1), not x radius². Absent pixels count
    as not flagged.
    """
    half = F.array(*[F.lit(math.isqrt(radius * radius - dy * dy)) for dy in range(-radius, radius + 1)])
    on = pixels.where(F.col(flag)).select(*keys, "x", "y", F.posexplode(half).alias("i", "w"))
    edges = on.select(*keys, (F.col("y") + F.col("i") - radius).alias("y"), F.explode(F.array(F.struct((F.col("x") - F.col("w")).alias("x"), F.lit(1).alias("d")), F.struct((F.col("x") + F.col("w") + 1).alias("x"), F.lit(-1).alias("d")))).alias("e"))
    edges = edges.groupBy(*keys, "y", F.col("e.x").alias("x")).agg(F.sum("e.d").alias("d"))
    here = pixels.select(*keys, "x", "y", F.lit(0).cast("long").alias("d"), F.lit(True).alias("own"))
    rows = here.unionByName(edges.withColumn("own", F.lit(False)))
    along = Window.partitionBy(*keys, "y").orderBy("x").rangeBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("n", F.sum("d").over(along)).where("own").select(*keys, "x", "y", "n")


#: Pixels on a side of the chunks that masks are worked out in, and rows that a task holds at once at least, if it has them.
CHUNK, ROWS = 512, 1 << 18


class Near:
    """Pixels of several groups, in order of group, row and column; places (x, y) are whole numbers, ``known`` tells who has one."""

    def __init__(self, group: np.ndarray, x: np.ndarray, y: np.ndarray, known: np.ndarray, reach: int):
        x, y = (np.where(known, v, v[known].min() if known.any() else 0) for v in (x, y))
        self.reach, self.known = reach, known
        self.wide = int(x.max() - x.min()) + 1 + 2 * reach
        high = int(y.max() - y.min()) + 1 + 2 * reach
        self.key = (group * high + y - y.min() + reach) * self.wide + x - x.min() + reach
        self.order = np.argsort(self.key, kind="stable")
        self.sorted = self.key[self.order]

    def within(self, flag: np.ndarray, half: Sequence[int]) -> np.ndarray:
        """Whether a flagged pixel of the group lies at most half[i] columns away in the row i - len(half) // 2 away.

        Each row is one binary search in the flagged pixels for the pixels that none was found for so far.
        """
        hit = np.zeros(len(flag), bool)
        on, left = self.sorted[(flag & self.known)[self.order]], self.order[self.known[self.order]]
        for i in sorted(range(len(half)), key=lambda i: abs(i - len(half) // 2)):
            if not len(on) or not len(left):
                break
            at = self.key[left] + (i - len(half) // 2) * self.wide
            first = np.searchsorted(on, at - half[i])
            found = (first < len(on)) & (on[np.minimum(first, len(on) - 1)] <= at + half[i])
            hit[left[found]] = True
            left = left[~found]
        return hit

    def first(self) -> np.ndarray:
        """Whether a pixel is the first of its group and place."""
        out = np.zeros(len(self.key), bool)
        out[self.order[np.append(True, self.sorted[1:] != self.sorted[:-1])]] = True
        return out

    def disk(self, flag: np.ndarray, radius: int) -> np.ndarray:
        return self.within(flag, [math.isqrt(radius * radius - dy * dy) for dy in range(-radius, radius + 1)])

    def square(self, flag: np.ndarray, size: int) -> np.ndarray:
        return self.within(flag, [size // 2] * (2 * (size // 2) + 1))


def by_chunks(pixels: DataFrame, keys: Sequence[str], flags: Sequence[Column], reach: int | Column, work: Callable[..., np.ndarray], name: str, once: bool = False) -> DataFrame:
    """(keys, x, y, name): a row for each pixel with what work(near, *flags) says of it; work looks no further than reach pixels.

    Pixels are dealt once to square chunks of CHUNK pixels and those whose halo of ``reach`` holds them, the only shuffle,
    and a task works on whole chunks, many small ones at once: memory is bound by a chunk and its halo, and what is
    shuffled is the pixels and their halo, whatever the reach. Chunks are laid around the origin, so a raster that begins
    there needs no chunk before it. reach may be a column of the keys. A pixel without a place keeps its row; it is near none. once: a
    row for each place.
    """
    reach = F.lit(reach) if isinstance(reach, int) else reach.cast("int")
    at = lambda v, d: F.floor((F.col(v) + d + CHUNK // 2) / CHUNK)
    dealt = pixels.select(*keys, "x", "y", reach.alias("_reach"), *[F.coalesce(f, F.lit(False)).alias(f"_f{i}") for i, f in enumerate(flags)])
    for v in ("x", "y"):
        dealt = dealt.withColumn(f"_c{v}", F.explode_outer(F.sequence(at(v, -F.col("_reach")), at(v, F.col("_reach")))))
    dealt = dealt.withColumn("_own", F.col("_cx").eqNullSafe(at("x", F.lit(0))) & F.col("_cy").eqNullSafe(at("y", F.lit(0))))
    parts, own_columns, names = [*keys, "_cx", "_cy"], [*keys, "x", "y"], [f"_f{i}" for i in range(len(flags))]
    schema = pixels.select(*keys, "x", "y", F.lit(True).alias(name)).schema

    def groups(table: pa.Table) -> np.ndarray:
        same = np.ones(max(0, table.num_rows - 1), bool)
        for c in parts:
            code = table[c].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
            same &= code[1:] == code[:-1]
        return np.concatenate([[0], np.cumsum(~same)])

    def judged(table: pa.Table, group: np.ndarray) -> pa.Table:
        known = pc.and_(table["x"].is_valid(), table["y"].is_valid()).to_numpy()
        x, y = (pc.fill_null(table[v].cast(pa.int64()), 0).to_numpy() for v in ("x", "y"))
        far = table["_reach"].to_numpy()
        out, own = np.zeros(len(x), bool), table["_own"].to_numpy().copy()
        for r in np.unique(far):
            some = far == r
            near = Near(group[some], x[some], y[some], known[some], int(r))
            out[some] = work(near, *[table[c].to_numpy()[some] for c in names])
            if once:
                own[some] &= near.first() | ~known[some]
        return table.select(own_columns).append_column(name, pa.array(out)).filter(pa.array(own)).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, ROWS
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n < enough:
                continue
            table = pa.Table.from_batches(held)
            group = groups(table)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield from judged(table.slice(0, cut), group[:cut]).to_batches()
            held, n = table.slice(cut).to_batches(), n - cut
            enough = max(ROWS, 2 * n)
        if n:
            table = pa.Table.from_batches(held)
            yield from judged(table, groups(table)).to_batches()

    return dealt.repartition(*parts).sortWithinPartitions(*parts).mapInArrow(run, schema)


def dilate_disk(pixels: DataFrame, flag: str, radius: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, x, y, flag): true where a flagged pixel lies within the disk x² + y² <= radius².

    Absent pixels count as not flagged, and don't stand in the way.
    """
    return by_chunks(pixels, keys, [F.col(flag)], radius, lambda near, f: near.disk(f, radius), flag)


def erode_disk(pixels: DataFrame, flag: str, radius: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, x, y, flag): true where no unflagged pixel of the table lies within the disk; a null flag counts as unflagged."""
    return by_chunks(pixels, keys, [F.col(flag)], radius, lambda near, f: ~near.disk(~f, radius), flag)


def dilate_square(pixels: DataFrame, flag: str, size: int | Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, x, y, flag): true where a flagged pixel lies within a size x size square; size may be a column of the keys.

    Absent pixels count as not flagged, and don't stand in the way.
    """
    half = size // 2 if isinstance(size, int) else F.floor(size / 2)
    return by_chunks(pixels, keys, [F.col(flag)], half, lambda near, f: near.square(f, 2 * near.reach), flag)


def satio_mask(scl: DataFrame, keys: Sequence[str] = (), erode: int = 3, dilate: int = 21) -> DataFrame:
    """(keys, x, y, mask): bad scene classes, specks removed by erosion, then grown; both in one pass over the chunks."""
    grown = lambda near, bad: near.disk(~near.disk(~bad, erode), dilate)
    return by_chunks(scl, keys, [scl_bad(F.col("scl"))], erode + dilate, grown, "mask")


def two_mask(cells: DataFrame, code: str, keep: Sequence[int], bad: Sequence[int], kernels: tuple[int, int] = (17, 77), erosion: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, x, y, mask): classes outside keep, eroded and grown by the first kernel, or in bad, by the second.

    A null class is in neither: it masks nothing, and keeps what is around it from standing after the erosion. A row for each place.
    """
    flags = [~F.col(code).isin(*keep), F.col(code).isin(*bad)]
    grown = lambda near, *f: np.logical_or(*[near.square(~near.disk(~m, erosion), k) for m, k in zip(f, kernels, strict=True)])
    return by_chunks(cells, keys, flags, erosion + max(kernels) // 2, grown, "mask", once=True)


def apply_mask(cube: DataFrame, mask: DataFrame, bands: Sequence[str], on: Sequence[str] = ("x", "y")) -> DataFrame:
    """cube with its bands null where mask is true; pixels without a mask row keep theirs."""
    other = [c for c in cube.columns if c not in bands]
    return cube.join(mask, list(on), "left").select(*other, *mask_bands(bands, F.col("mask")))


def mask_as_band(cube: DataFrame, mask: DataFrame, name: str = "S2-CLOUD-MASK", on: Sequence[str] = ("x", "y")) -> DataFrame:
    return cube.join(mask.withColumnRenamed("mask", name), list(on), "left").select(*cube.columns, name)


def resample_near(cube: DataFrame, bands: Sequence[str], factor: float, keys: Sequence[str] = ()) -> DataFrame:
    """Nearest-neighbour resampling to pixels factor times as wide (below 1: finer), aligned at the upper left.

    Coarser: the source pixel whose centre is nearest to the target's centre, ties to the smaller y, then x. Finer: each
    source pixel is copied to the target pixels whose centres it holds.
    """
    if factor < 1:
        n = round(1 / factor)
        out = cube.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        return out.select(*keys, (F.col("x") * n + F.col("_i")).alias("x"), (F.col("y") * n + F.col("_j")).alias("y"), *bands)
    tx, ty = F.floor(F.col("x") / factor).cast("int"), F.floor(F.col("y") / factor).cast("int")
    dx, dy = F.col("x") + 0.5 - (tx + 0.5) * factor, F.col("y") + 0.5 - (ty + 0.5) * factor
    rank = F.struct((dx * dx + dy * dy).alias("d"), "y", "x")
    picked = cube.select(*keys, tx.alias("_x"), ty.alias("_y"), "x", "y", *bands).groupBy(*keys, "_x", "_y").agg(F.min_by(F.struct(*bands), rank).alias("v"))
    return picked.select(*keys, F.col("_x").alias("x"), F.col("_y").alias("y"), *[F.col(f"v.{b}").alias(b) for b in bands])


def resample_bilinear(cube: DataFrame, bands: Sequence[str], factor: int) -> DataFrame:
    """Bilinear resampling to pixels 1 / factor as wide: weights of the four source pixels around each target centre, over those present."""
    n = F.sequence(F.lit(0), F.lit(factor - 1))
    fine = cube.select("x", "y").withColumn("_i", F.explode(n)).withColumn("_j", F.explode(n))
    fine = fine.select((F.col("x") * factor + F.col("_i")).alias("tx"), (F.col("y") * factor + F.col("_j")).alias("ty"))
    px, py = (F.col("tx") + 0.5) / factor - 0.5, (F.col("ty") + 0.5) / factor - 0.5
    fine = fine.select("tx", "ty", px.alias("px"), py.alias("py"), F.floor(px).cast("int").alias("x0"), F.floor(py).cast("int").alias("y0"))
    wx, wy = F.col("px") - F.col("x0"), F.col("py") - F.col("y0")
    near = F.array(*[F.struct((F.col("x0") + i).alias("x"), (F.col("y0") + j).alias("y"), ((wx if i else 1 - wx) * (wy if j else 1 - wy)).alias("w")) for i in (0, 1) for j in (0, 1)])
    spread = fine.select("tx", "ty", F.explode(near).alias("s")).select("tx", "ty", "s.x", "s.y", "s.w").join(cube.select("x", "y", *bands), ["x", "y"])
    means = [F.try_divide(F.sum(F.col("w") * F.col(b)), F.sum(F.when(F.col(b).isNotNull(), F.col("w")))).alias(b) for b in bands]
    return spread.groupBy(F.col("tx").alias("x"), F.col("ty").alias("y")).agg(*means)


def with_halo(pixels: DataFrame, size: int, halo: int) -> DataFrame:
    """Rows of pixels for every chunk of size pixels whose halo holds them: columns chunk_x, chunk_y and is_core are added."""

    def chunks(v: str) -> Column:
        return F.sequence(F.floor((F.col(v) - halo) / size).cast("int"), F.floor((F.col(v) + halo) / size).cast("int"))

    out = pixels.withColumn("chunk_x", F.explode(chunks("x"))).withColumn("chunk_y", F.explode(chunks("y")))
    core = (F.floor(F.col("x") / size) == F.col("chunk_x")) & (F.floor(F.col("y") / size) == F.col("chunk_y"))
    return out.withColumn("is_core", core)


def apply_chunks(pixels: DataFrame, function, schema: str, size: int, halo: int = 0) -> DataFrame:
    """function(pandas frame of a chunk with its halo) for each chunk; it returns rows of schema for the core pixels."""
    return with_halo(pixels, size, halo).groupBy("chunk_x", "chunk_y").applyInPandas(function, schema)
