"""Classification: winning classes, hierarchical maps, probabilities, scaling, component projection, model scoring."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed value: the name pattern of a class-probability band.
BAND = r"^Level(\d+)_class-(.+)_habitat-(.+)-(\d+)$"


def parse_band(name: Column) -> list[Column]:
    """level, model, habitat and raster_code of a band name."""
    group = lambda i: F.regexp_extract(name, BAND, i)
    return [F.try_to_number(group(1), F.lit("999")).cast("int").alias("level"), group(2).alias("model"), group(3).alias("habitat"), group(4).try_cast("int").alias("raster_code")]


def parent_code(code: Column, level: int) -> Column:
    """Code of the parent class: level 2 keeps the ten thousands, level 3 the hundreds."""
    unit = {2: 10_000, 3: 100}[level]
    return (F.floor(code / unit) * unit).cast("int")


def argmax_wide(bands: Sequence[str], codes: Sequence[int]) -> Column:
    """Code of the band with the largest value; ties to the first, nulls as 0, null if all are null."""
    filled = F.array(*[F.coalesce(F.col(b), F.lit(0.0)) for b in bands])
    at = F.array_position(filled, F.array_max(filled)).cast("int") - 1
    return F.when(F.coalesce(*[F.col(b) for b in bands]).isNotNull(), F.get(F.array(*map(F.lit, codes)), at))


def argmax_long(probs: DataFrame, keys: Sequence[str], code: str = "raster_code", p: str = "prob", order: str = "band_nr") -> DataFrame:
    """(keys, code): the winner of each key by largest value, then smallest band number; keys with nulls only are null."""
    best = Window.partitionBy(*keys).orderBy(F.coalesce(p, F.lit(0.0)).desc(), order)
    seen = F.count(p).over(Window.partitionBy(*keys))
    ranked = probs.withColumn("_r", F.row_number().over(best)).withColumn("_n", seen).where("_r = 1")
    return ranked.select(*keys, F.when(F.col("_n") > 0, F.col(code)).alias(code))


def hierarchical(winners: DataFrame, level1: str, children: Sequence[tuple[str, int, int]]) -> DataFrame:
    """winners with column code: the level-1 class, replaced where it equals a child's parent by the child's winner.

    children: (column, parent code, level), applied in order of level; 0, -1 and null replace nothing.
    """
    code = F.col(level1)
    for column, parent, _ in sorted(children, key=lambda c: c[2]):
        child = F.col(column)
        code = F.when((code == parent) & child.isNotNull() & ~child.isin(0, -1), child).otherwise(code)
    return winners.withColumn("code", code)


def check_one_parent(winners: DataFrame, column: str, level: int) -> None:
    """Raises if the codes of a column belong to more than one parent class."""
    n = winners.where(F.col(column).isNotNull() & ~F.col(column).isin(0, -1)).agg(F.countDistinct(parent_code(F.col(column), level)).alias("n")).first().n
    if n > 1:
        raise ValueError(f"{column} spans {n} parents")


def to_percent(p: Column) -> Column:
    """Probability to whole percent, truncated."""
    return F.floor(p * 100).cast("int")


def minmax(df: DataFrame, bands: Sequence[str], chunk: Sequence[str] = ()) -> DataFrame:
    """Bands scaled to 0 to 1 by their range over the chunk (all rows if none); a constant band becomes 0."""
    if chunk:
        ranges = df.groupBy(*chunk).agg(*[f(b).alias(f"_{n}_{b}") for b in bands for n, f in (("lo", F.min), ("hi", F.max))])
        joined = df.join(ranges, list(chunk))
    else:
        joined = df.crossJoin(F.broadcast(df.agg(*[f(b).alias(f"_{n}_{b}") for b in bands for n, f in (("lo", F.min), ("hi", F.max))])))  # one row
    scaled = lambda b: F.when(F.col(b).isNotNull(), F.coalesce(F.try_divide(F.col(b) - F.col(f"_lo_{b}"), F.col(f"_hi_{b}") - F.col(f"_lo_{b}")), F.lit(0.0))).alias(b)
    return joined.select(*[scaled(c) if c in bands else F.col(c) for c in df.columns])


#: Bins of a counting pass, and accuracy of the sketch that brackets the wanted ranks before it.
BINS, ACCURACY = 4096, 10_000


def exact_percentiles_of(df: DataFrame, bands: Sequence[str], shares: Sequence[float]) -> dict[str, list[float] | None]:
    """Percentiles with linear interpolation of all bands together; None for a band without finite values.

    Null, NaN and infinite values take no part. One scan merges a quantile sketch of every band, which brackets the wanted
    ranks. The next counts, in one aggregation for all bands and ranks, what is below each bracket and in BINS bins of it,
    with each bin's least and greatest value; where these differ for a wanted bin it becomes the bracket of another scan, so
    two scans do for values of limited digits; at most BINS values of a bracket are read as they are. A bracket that misses its rank falls back to the whole range: the result
    doesn't rest on the sketch. A scan always parts the ends of a bracket, so it comes to an end. Only counts leave the tasks.
    """
    values = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.col(f"`{b}`").cast("double").alias("v")) for i, b in enumerate(bands)])).alias("r")).select("r.band", "r.v")
    values = values.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf"))).withColumn("v", F.col("v") + 0.0)
    around = [min(1.0, max(0.0, p + e)) for p in shares for e in (-3 / ACCURACY, 3 / ACCURACY)]
    sketch = F.percentile_approx("v", F.array(*map(F.lit, around)), ACCURACY).alias("q")
    found = {r.band: r for r in values.groupBy("band").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), sketch).collect()}  # a row for each band
    bracket: dict[tuple[int, int], tuple[float, float]] = {}  # of each band and rank
    for band, r in found.items():
        for i, p in enumerate(shares):
            for rank in (int(p * (r.n - 1)), min(int(p * (r.n - 1)) + 1, r.n - 1)):
                bracket[band, rank] = (r.q[2 * i], r.q[2 * i + 1])
    sure: set[tuple[int, int]] = set()
    few: dict[tuple[int, int], int] = {}  # places among the values of small brackets
    while open_ := sorted({(band, *bracket[band, rank]) for band, rank in bracket if (band, rank) not in sure}):
        ranges = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(k).alias("k")) for k, (b, lo, hi) in enumerate(open_)])
        met = values.select("v", F.explode(F.filter(ranges, lambda r: (r["band"] == F.col("band")) & (F.col("v") <= r["hi"]))).alias("r"))
        v, lo, hi = F.col("v"), F.col("r.lo"), F.col("r.hi")
        share = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)  # halves: the width may be more than a double holds
        bins = F.when(v < lo, -1).when(share.isNull(), (v > lo).cast("int")).otherwise(F.least(F.floor(share * BINS), F.lit(BINS - 1)))
        counts: dict[int, list] = {}
        binned = met.groupBy("r.k", bins.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()  # BINS for each bracket
        for r in sorted(binned, key=lambda r: (r.k, r.bin)):
            counts.setdefault(r.k, []).append(r)
        for band, rank in set(bracket) - sure:
            left, hit = rank, None
            for r in counts.get(open_.index((band, *bracket[band, rank])), []):
                if left < r.n:
                    hit = r
                    break
                left -= r.n
            if hit is None or hit.bin < 0:
                bracket[band, rank] = (found[band].lo, found[band].hi)
                continue
            bracket[band, rank] = (hit.lo, hit.hi)
            if hit.lo == hit.hi or hit.n <= BINS:
                sure.add((band, rank))
                few |= {(band, rank): left} if hit.lo < hit.hi else {}
    if few:
        spans = {(band, *bracket[band, rank]) for band, rank in few}
        met = values.where(functools.reduce(operator.or_, [(F.col("band") == b) & F.col("v").between(lo, hi) for b, lo, hi in sorted(spans)])).collect()  # BINS for each bracket at most
        for (band, rank), left in few.items():
            lo, hi = bracket[band, rank]
            bracket[band, rank] = (sorted(r.v for r in met if r.band == band and lo <= r.v <= hi)[left],) * 2
    out: dict[str, list[float] | None] = {}
    for i, b in enumerate(bands):
        out[b] = None if i not in found else []
        for p in shares if i in found else ():
            x = p * (found[i].n - 1)
            lo, hi = bracket[i, int(x)][0], bracket[i, min(int(x) + 1, found[i].n - 1)][0]
            out[b].append(lo + (hi - lo) * (x - int(x)) if x > int(x) else lo)
    return out


def exact_percentiles(df: DataFrame, band: str, shares: Sequence[float]) -> list[float] | None:
    """exact_percentiles_of one band."""
    return exact_percentiles_of(df, [band], shares)[band]


def percentile_stretch(df: DataFrame, bands: Sequence[str], low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Bands clipped to two percentiles of their finite values and scaled to 0 to 1; infinite values are clipped too, NaN becomes null."""
    edges = exact_percentiles_of(df, bands, (low, high))

    def stretched(b: str) -> Column:
        lo, hi = map(F.lit, edges[b] or (0.0, 0.0))
        v = F.nanvl(F.col(b).cast("double"), F.lit(None).cast("double"))
        return F.when(v.isNotNull(), F.try_divide(F.least(F.greatest(v, lo), hi) - lo, hi - lo)).alias(b)

    return df.select(*[stretched(c) if c in bands else F.col(c) for c in df.columns])


def project(df: DataFrame, bands: Sequence[str], loadings: Sequence[Sequence[float]], keep: Sequence[str] = ("x", "y")) -> DataFrame:
    """(keep, COMP1..n): bands, nulls as 0, times the columns of loadings (a row for each band)."""
    comps = []
    for k in range(len(loadings[0]) if loadings else 0):
        total = F.lit(0.0)
        for b, row in zip(bands, loadings, strict=True):
            total = total + F.coalesce(F.col(b).cast("double"), F.lit(0.0)) * row[k]
        comps.append(total.alias(f"COMP{k + 1}"))
    return df.select(*keep, *comps)


def fit_pca(df: DataFrame, bands: Sequence[str], n: int):
    """Spark ML's PCA over the bands, nulls as 0."""
    from pyspark.ml.feature import PCA, VectorAssembler

    made = VectorAssembler(inputCols=list(bands), outputCol="v").transform(df.select(*bands).na.fill(0.0))
    return PCA(k=n, inputCol="v", outputCol="c").fit(made)


def loading_table(df: DataFrame, bands: Sequence[str], n: int) -> DataFrame:
    """(band, comp, loading) of a fitted PCA; its size is that of the band list."""
    pc = fit_pca(df, bands, n).pc.toArray()
    pc = pc * [1 if column[abs(column).argmax()] > 0 else -1 for column in pc.T]  # a component's largest loading is positive
    rows = [(b, k + 1, float(pc[i, k])) for i, b in enumerate(bands) for k in range(n)]
    return df.sparkSession.createDataFrame(rows, "band string, comp int, loading double")


def contribution(loadings: DataFrame) -> DataFrame:
    """(band, score): each band's share of the sum of absolute loadings."""
    by = loadings.groupBy("band").agg(F.sum(F.abs("loading")).alias("s"))
    return by.crossJoin(F.broadcast(by.agg(F.sum("s").alias("all")))).select("band", (F.col("s") / F.col("all")).alias("score"))


def top_bands(scores: DataFrame, k: int | None = None, threshold: float | None = None) -> DataFrame:
    """The k best bands, or those from a threshold on; all if none is left."""
    if k is not None:
        return scores.orderBy(F.desc("score"), "band").limit(k)
    kept = scores.where(F.col("score") >= threshold)
    return kept if kept.limit(1).count() else scores


def select_bands(df: DataFrame, scores: DataFrame, keep: Sequence[str], k: int | None = None, threshold: float | None = None) -> DataFrame:
    """df with the significant bands only, in its own order."""
    wanted = {r.band for r in top_bands(scores, k, threshold).select("band").collect()}  # at most the band list
    return df.select(*keep, *[c for c in df.columns if c in wanted])


def score_models(df: DataFrame, models: Sequence[dict], load: Callable[[str], Callable], keep: Sequence[str] = ("x", "y")) -> DataFrame:
    """Bands of whole percents for every model: {"id", "inputs", "outputs"}.

    load(id) gives a function from a float32 matrix to a matrix of probabilities; it is called once in each worker process.
    """
    names = [o for m in models for o in m["outputs"]]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`{n}` int" for n in names])

    def run(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        ready: dict = {}
        for f in frames:
            parts = {c: f[c] for c in keep}
            for m in models:
                if m["id"] not in ready:
                    ready[m["id"]] = load(m["id"])
                p = ready[m["id"]](f[list(m["inputs"])].fillna(0).to_numpy(np.float32))
                if p.shape[1] != len(m["outputs"]):
                    raise ValueError(f"model {m['id']} gives {p.shape[1]} classes, not {len(m['outputs'])}")
                parts |= {o: np.floor(p[:, i] * 100).astype(np.int32) for i, o in enumerate(m["outputs"])}
            yield pd.DataFrame(parts)

    return df.mapInPandas(run, schema)


def model_row(registry: DataFrame, model_id: str) -> DataFrame:
    """The one registry row of a model; raises if there isn't exactly one."""
    hit = registry.where(F.col("model_id") == model_id)
    n = hit.limit(2).count()
    if n != 1:
        raise LookupError(f"{'no' if not n else 'more than one'} model {model_id}")
    return hit
