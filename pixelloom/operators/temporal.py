"""Operators along time: period composites, densifying, interpolation and per-pixel statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelloom.operators.joins import by_rows

PIXEL = ("x", "y")
PERIODS = ("day", "week", "dekad", "month", "season", "year")


def period_start(t: Column, period: str) -> Column:
    """First day of the period that holds t. Dekads start on days 1, 11 and 21; seasons in December, March, June, September."""
    d = F.to_date(t)
    if period in ("P1M", "month"):
        return F.trunc(d, "month")
    if period == "day":
        return d
    if period in ("week", "year"):
        return F.trunc(d, period)
    if period == "dekad":
        return F.make_date(F.year(d), F.month(d), 1 + 10 * F.least(F.floor((F.dayofmonth(d) - 1) / 10), F.lit(2)).cast("int"))
    if period == "season":
        return F.add_months(F.trunc(F.add_months(d, 1), "quarter"), -1)
    raise ValueError(f"period must be one of {PERIODS}")


def _edge(pick: Callable, t: str) -> Callable[[Column], Column]:
    # the value breaks ties of equal times; rows without a value don't take part
    return lambda v: pick(v, F.when(v.isNotNull(), F.struct(F.col(t), v)))


def reducers(t: str = "t") -> dict[str, Callable[[Column], Column]]:
    """The temporal reducers; all of them skip nulls."""
    return {
        "median": F.median, "mean": F.avg, "max": F.max, "min": F.min, "first": _edge(F.min_by, t), "last": _edge(F.max_by, t),
        "product": F.product, "sd": F.stddev_samp, "sum": F.sum, "variance": F.var_samp,
    }


def _medians(rows: GroupedData, bands: Sequence[str]) -> DataFrame:
    """The median of each band as an exact percentile gives it, from one list of rows instead of a table of values for each band.

    Falling order puts nulls last, so the count of values tells the two in the middle.
    """
    kept = rows.agg(F.collect_list(F.struct(*[F.col(f"`{b}`") for b in bands])).alias("_s"), *[F.count(F.col(f"`{b}`")).alias(f"_n{i}") for i, b in enumerate(bands)])
    keys = [c for c in kept.columns if c != "_s" and c not in {f"_n{i}" for i in range(len(bands))}]

    def middle(i: int, b: str) -> Column:
        values, n = F.sort_array(F.col(f"_s.`{b}`"), False), F.col(f"_n{i}")
        low, high = F.get(values, F.floor((n - 1) / 2).cast("int")), F.get(values, F.floor(n / 2).cast("int"))
        return F.when(n > 0, low.cast("double") * 0.5 + high.cast("double") * 0.5 + 0.0).alias(b)

    return kept.select(*keys, *[middle(i, b) for i, b in enumerate(bands)])


def composite(
    df: DataFrame, bands: Sequence[str], period: str, reducer: str = "median", t: str = "t", keys: Sequence[str] = PIXEL, by_pixel: bool = False, dealt: bool = False, tasks: int | None = None
) -> DataFrame:
    """One row for each pixel and period with every band reduced; one shuffle, or none where rows are dealt by pixel already.

    by_pixel, and the median, whose partial results are as large as its input, shuffle the rows by pixel first: statistics
    and interpolation over time that follow then need no shuffle of their own. Otherwise rows are reduced before the shuffle.
    tasks: how many tasks rows are dealt to by pixel; as many as df has rows for if not given.
    """
    f = reducers(t)[reducer]
    if not dealt and (by_pixel or reducer == "median"):
        tasks = tasks or by_rows(df)
        df = df.repartition(tasks, *keys) if tasks else df.repartition(*keys)
    rows = df.groupBy(*keys, period_start(F.col(t), period).alias("period"))
    out = _medians(rows, bands) if reducer == "median" else rows.agg(*[f(F.col(b)).alias(b) for b in bands])
    return out.withColumnRenamed("period", t)


def calendar(start: str, stop: str, period: str) -> list[date]:
    """First days of the periods that days from start up to stop are in; worked out on the driver."""
    first, last = date.fromisoformat(start), date.fromisoformat(stop) - timedelta(1)
    if period in ("day", "week"):
        step = 7 if period == "week" else 1
        first -= timedelta(first.weekday() if period == "week" else 0)
        return [first + timedelta(i) for i in range(0, (last - first).days + 1, step)]
    months = [(y, m) for y in range(first.year - 1, last.year + 1) for m in range(1, 13)]
    starts = {
        "month": [date(y, m, 1) for y, m in months], "P1M": [date(y, m, 1) for y, m in months], "year": [date(y, 1, 1) for y, m in months if m == 1],
        "season": [date(y, m, 1) for y, m in months if m % 3 == 0], "dekad": [date(y, m, d) for y, m in months for d in (1, 11, 21)],
    }
    if period not in starts:
        raise ValueError(f"period must be one of {PERIODS}")
    found = starts[period]
    begin = max((i for i, d in enumerate(found) if d <= first), default=0)
    return [d for d in found[begin:] if d <= last]


def _place(t: Column, first: date, period: str) -> Column:
    """How many periods t, the first day of one, lies after the period that begins with first."""
    months = (F.year(t) - first.year) * 12 + F.month(t) - first.month
    if period in ("day", "week"):
        return F.floor(F.datediff(t, F.lit(first)) / (7 if period == "week" else 1)).cast("int")
    if period == "dekad":
        return (months * 3 + F.floor(F.dayofmonth(t) / 10) - first.day // 10).cast("int")
    return F.floor(months / {"year": 12, "season": 3}.get(period, 1)).cast("int")


def pack(df: DataFrame, keys: Sequence[str], first: Sequence[str | Column], where: Column | None = None) -> DataFrame:
    """(keys, s): one row for each pixel, s its rows as structs in the order of ``first`` and the other columns; no shuffle of its own after one by the keys."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys and c not in first]
    row = F.struct(*first, *rest)
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(row if where is None else F.when(where, row))).alias("s"))


def densify(df: DataFrame, start: str, stop: str, period: str, t: str = "t", keys: Sequence[str] = PIXEL) -> DataFrame:
    """df with a row for every pixel and every period from start up to stop; bands are null where there was none.

    A pixel's rows are packed into one by a single shuffle; the periods between two of its times are cut out of the
    calendar, so no table of pixels and periods is made or joined. Rows off the calendar drop out; times stay dates.
    """
    days = calendar(start, stop, period)
    others = [c for c in df.columns if c not in keys and c != t]
    kinds = {f.name: f.dataType for f in df.schema}
    if not days:
        return df.limit(0)
    place = _place(F.to_date(t), days[0], period)
    on = F.col(t).isNotNull() & (period_start(F.col(t), period) == F.col(t)) & place.between(0, len(days) - 1)
    packed = pack(df.select(*keys, place.alias("_i"), F.to_date(t).alias(t), *others), keys, ["_i", t], on)
    every = F.array(*map(F.lit, days))
    blank = lambda d: F.struct(d.alias(t), *[F.lit(None).cast(kinds[c]).alias(c) for c in others])
    own = lambda p: F.struct(p[t].alias(t), *[p[c].alias(c) for c in others])
    cut = lambda i, n: F.transform(F.slice(every, i + 1, F.greatest(n, F.lit(0))), blank)
    known = F.transform("s", lambda p, k: F.concat(F.array(own(p)), cut(p["_i"] + 1, F.coalesce(F.get("s", k + 1)["_i"], F.lit(len(days))) - p["_i"] - 1)))
    filled = F.concat(cut(F.lit(0), F.coalesce(F.get("s", F.lit(0))["_i"], F.lit(len(days)))), F.flatten(known))
    return packed.select(*keys, F.inline(filled)).select(*df.columns)


def fill_linear(at: Column, v: Column) -> Column:
    """The array v with nulls between two values filled linearly along the array at; linear in their length.

    Between one known value and the next a run of values is worked out; the runs are put together.
    """
    points = F.filter(F.transform(v, lambda x, i: F.struct(i.alias("i"), F.get(at, i).alias("at"), x.cast("double").alias("v"))), lambda p: p["v"].isNotNull())

    def runs(known: Column) -> Column:
        def run(a: Column, k: Column) -> Column:
            b = F.get(known, k + 1)
            inner = F.transform(F.slice(at, a["i"] + 2, F.greatest(b["i"] - a["i"] - 1, F.lit(0))), lambda x: a["v"] + (b["v"] - a["v"]) * F.try_divide(x - a["at"], b["at"] - a["at"]))
            return F.when(b.isNull(), F.array(a["v"])).otherwise(F.concat(F.array(a["v"]), inner))

        none = lambda n: F.array_repeat(F.lit(None).cast("double"), n.cast("int"))
        last = F.get(known, F.size(known) - 1)["i"]
        return F.when(F.size(known) == 0, none(F.size(v))).otherwise(F.concat(none(F.get(known, F.lit(0))["i"]), F.flatten(F.transform(known, run)), none(F.size(v) - 1 - last)))

    return F.transform(F.array(points), runs)[0]


def interpolate(df: DataFrame, bands: Sequence[str], t: str = "t", keys: Sequence[str] = PIXEL, on_time: bool = False) -> DataFrame:
    """Fill nulls between two values linearly by position (or by time); nulls before the first and after the last stay.

    A pixel's rows are packed into arrays of times and bands by one shuffle; time is linear in the length of its series.
    """
    packed = pack(df, keys, [t])
    at = F.transform("s", (lambda p: F.unix_timestamp(p[t].cast("timestamp")).cast("double")) if on_time else (lambda p, i: i.cast("double")))
    arrays = packed.select(*keys, "s", at.alias("_at"))
    filled = arrays.select(*keys, "s", *[fill_linear(F.col("_at"), F.col(f"s.`{b}`")).alias(f"_f{i}") for i, b in enumerate(bands)])
    row = F.explode(F.arrays_zip("s", *[f"_f{i}" for i in range(len(bands))])).alias("r")
    value = lambda c: F.col(f"r._f{list(bands).index(c)}").alias(c) if c in bands else F.col(f"r.s.`{c}`").alias(c)
    return filled.select(*keys, row).select(*[F.col(c) if c in keys else value(c) for c in df.columns])


# Names and order of the statistics of a feature cube.
FEATURES = ("p2", "p25", "median", "p75", "p98", "mean", "sd", "sum", "iqr")
STATS8 = ("mean", "median", "min", "max", "q05", "q25", "q75", "q95")


def temporal_features(df: DataFrame, bands: Sequence[str], keys: Sequence[str] = PIXEL) -> DataFrame:
    """<band>_<stat> for the nine FEATURES of each band over time: one aggregation, one percentile pass a band."""
    aggs = []
    for b in bands:
        v = F.col(b).cast("double")
        aggs += [F.percentile(v, F.array(*map(F.lit, (0.02, 0.25, 0.5, 0.75, 0.98)))).alias(f"_{b}"), F.avg(v).alias(f"{b}_mean"), F.stddev_samp(v).alias(f"{b}_sd"), F.sum(v).alias(f"{b}_sum")]
    out = df.groupBy(*keys).agg(*aggs)
    place = {"p2": 0, "p25": 1, "median": 2, "p75": 3, "p98": 4}

    def stat(b: str, s: str) -> Column:
        q = F.col(f"_{b}")
        v = q[place[s]] if s in place else q[3] - q[1] if s == "iqr" else F.col(f"{b}_{s}")
        return v.alias(f"{b}_{s}")

    return out.select(*keys, *[stat(b, s) for b in bands for s in FEATURES])


def temporal_stats8(df: DataFrame, bands: Sequence[str], keys: Sequence[str] = PIXEL) -> DataFrame:
    """mean, median, min, max and four quantiles of each band over time."""
    aggs = []
    for b in bands:
        v = F.col(b).cast("double")
        aggs += [F.avg(v).alias(f"{b}_mean"), F.min(v).alias(f"{b}_min"), F.max(v).alias(f"{b}_max"), F.percentile(v, F.array(*map(F.lit, (0.5, 0.05, 0.25, 0.75, 0.95)))).alias(f"_{b}")]
    place = {"median": 0, "q05": 1, "q25": 2, "q75": 3, "q95": 4}
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[(F.col(f"_{b}")[place[s]] if s in place else F.col(f"{b}_{s}")).alias(f"{b}_{s}") for b in bands for s in STATS8])


def drop_t(df: DataFrame, t: str = "t") -> DataFrame:
    """df without t, which must hold one value at most."""
    if df.select(t).distinct().limit(2).count() > 1:
        raise ValueError(f"{t} has more than one label")
    return df.drop(t)
