"""Mixing sources to target weights by a Pfair schedule of blocks, in DataFrame functions only."""

from __future__ import annotations

import heapq
import json
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pixelloom.llm.common import materialise, small_side

#: Most slots of one period of the schedule, which the driver works out (about 100 bytes a slot).
MAX_SLOTS = 100_000
#: Rows that one window group of the ranking holds on average at most.
GROUP_ROWS = 5_000
#: Stands for the null source.
NO_SOURCE = "\x00"


def targets(counts: dict[str, int], weights: dict[str, float] | None = None, temperature: float = 0.5) -> dict[str, Fraction]:
    """Exact target share of each source; shares add up to one.

    weights: any positive numbers, taken as the decimal fractions that they are written as (ints, floats, strings,
    Fractions). Without them a source's weight is its number of rows to the power temperature, to three digits of the
    largest, one at least.
    """
    if not counts:
        return {}
    if weights is None:
        most = max(counts.values()) ** temperature
        want = {s: Fraction(max(1, round(n**temperature / most * 1_000))) for s, n in counts.items()}
    else:
        want = {s: Fraction(str(weights[s])) for s in counts}
    if any(w <= 0 for w in want.values()):
        raise ValueError("weights must be positive")
    total = sum(want.values())
    return {s: w / total for s, w in want.items()}


def shares(target: dict[str, Fraction], most: int = MAX_SLOTS) -> dict[str, int]:
    """Slots of each source in one period: exactly its target where the period that this takes has at most ``most`` slots.

    Otherwise the period has ``most`` slots, dealt by largest remainder, one to each source at least; a source is then off
    its target by less than one slot a period.
    """
    slots = math.lcm(*(w.denominator for w in target.values())) if target else 0
    if slots <= most:
        return {s: int(w * slots) for s, w in target.items()}
    if len(target) > most:
        raise ValueError(f"{len(target)} sources; a period has at most {most} slots")
    out = {s: max(1, math.floor(w * most)) for s, w in target.items()}
    rest = most - sum(out.values())
    order = sorted(target, key=lambda s: (math.floor(target[s] * most) - target[s] * most, s) if rest > 0 else (-out[s], s))
    for i in range(abs(rest)):
        out[order[i % len(order)]] += 1 if rest > 0 else -1
    return out


def period(share: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, k, slot) for one period: the k-th block of each source, earliest deadline first.

    Block k of a source with share a of D slots is released at floor(k D / a) and due at ceil((k + 1) D / a).
    As the shares add up to D, every slot is filled and every deadline met; the pattern repeats each D slots.
    """
    d = sum(share.values())
    waiting = sorted((0, s, 0) for s in share)
    ready: list[tuple[int, str, int]] = []
    heapq.heapify(waiting)
    out = []
    for slot in range(d):
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * d // share[s]), s, k))
        due, s, k = heapq.heappop(ready)
        if slot >= due:
            raise AssertionError("missed deadline")
        out.append((s, k, slot))
        if k + 1 < share[s]:
            heapq.heappush(waiting, ((k + 1) * d // share[s], s, k + 1))
    return out


def _placed(docs: DataFrame, weights: dict[str, float] | None, block_rows: int, temperature: float, id_col: str, source_col: str, max_sources: int) -> tuple[DataFrame, int]:
    """(row, mix_block, mix_slot, mix_place, mix_due) and a bound of mix_slot: row is a struct of the columns of docs."""
    spark = docs.sparkSession
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    code = F.md5(F.coalesce(F.col(id_col).cast("string"), F.hex(whole)).cast("binary"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), source.alias("s"), code.alias("m"), whole.alias("h"))
    counts = {r["s"]: r["count"] for r in keyed.groupBy("s").count().limit(max_sources + 1).collect()}
    if len(counts) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    if weights is not None:
        weights = {NO_SOURCE if s is None else str(s): w for s, w in weights.items()}
    share = shares(targets(counts, weights, temperature))
    slots = max(1, sum(share.values()))
    last = max((-(-(-(-n // block_rows)) * slots // share[s]) for s, n in counts.items()), default=0)
    digits = max(1, math.ceil(math.log(max(2, max(counts.values(), default=1) / GROUP_ROWS), 16)))
    keyed = keyed.withColumn("g", F.substring("m", 1, digits))

    groups = keyed.groupBy("s", "g").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("s").orderBy("g").rowsBetween(Window.unboundedPreceding, -1))
    groups = small_side(materialise(groups.select("s", "g", F.coalesce(before, F.lit(0)).alias("before")), "groups"))
    own = F.row_number().over(Window.partitionBy("s", "g").orderBy("m", "h")) - 1
    ranked = keyed.withColumn("rank", own).join(groups, ["s", "g"]).withColumn("rank", F.col("rank") + F.col("before"))

    table = json.dumps([{"s": s, "k": k, "slot": at, "a": share[s]} for s, k, at in period(share)] if share else [])
    slot_of = spark.range(1).select(F.inline(F.from_json(F.lit(table), "array<struct<s string, k bigint, slot bigint, a bigint>>")))
    slot_of = small_side(materialise(slot_of, "period"))
    sizes = F.broadcast(slot_of.where("k = 0").select("s", "a"))  # at most max_sources rows
    blocks = ranked.withColumn("mix_block", F.floor(F.col("rank") / block_rows)).withColumn("mix_place", (F.col("rank") % block_rows).cast("int"))
    blocks = blocks.join(sizes, "s").withColumn("k", F.col("mix_block") % F.col("a"))
    placed = blocks.join(slot_of.select("s", "k", "slot"), ["s", "k"])
    turn = F.floor(F.col("mix_block") / F.col("a")) * slots
    due = turn + F.ceil((F.col("k") + 1) * slots / F.col("a"))
    return placed.select("row", "mix_block", (turn + F.col("slot")).alias("mix_slot"), "mix_place", due.cast("bigint").alias("mix_due")), last


def schedule(
    docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = 64, temperature: float = 0.5, id_col: str = "doc_id", source_col: str = "source",
    max_sources: int = 10_000,
) -> DataFrame:
    """The rows of docs with four more columns: mix_block, mix_slot, mix_place and mix_due; columns of these names are replaced.

    A source's rows, in the order of the MD5 of their id, form blocks of block_rows. Block b takes slot mix_slot, no later
    than its deadline mix_due and not before its release; mix_place is the row's place in the block. Read in the order
    (mix_slot, mix_place), every source has at each slot its target weight (see targets) to within one block, as long as
    it has rows; when one runs out the others go on in proportion. This holds at every length where the weights have a
    common period of at most MAX_SLOTS slots; otherwise the deviation is below two blocks for as many slots and grows by
    less than one block in each further MAX_SLOTS (see shares).

    All rows are kept. Null sources form a source of their own; rows without an id are ordered by a hash of the row, and
    so are rows with equal ids; repeated rows each have a place. An empty table stays empty. More than max_sources
    sources are an error: the driver holds a count for each, and the slots of one period.

    Ranks are counted in groups of a source and a few hex digits of the MD5, and offset by sums over the groups before, so
    that no source, however large, is ordered in one task.
    """
    added = ["mix_block", "mix_slot", "mix_place", "mix_due"]
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in added]
    return _placed(docs, weights, block_rows, temperature, id_col, source_col, max_sources)[0].select(*kept, *added)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = 64, temperature: float = 0.5, file_slots: int = 100, max_sources: int = 10_000) -> DataFrame:
    """All rows and columns of docs in schedule order: partition i has the rows of slots i * file_slots onwards, sorted.

    So when it is written, files in the order of their part numbers, read from first row to last, are the schedule (see
    file_order).
    """
    placed, last = _placed(docs, weights, block_rows, temperature, "doc_id", "source", max_sources)
    dealt = placed.repartitionById(max(1, -(-last // file_slots)), F.floor(F.col("mix_slot") / file_slots).cast("int"))
    dealt = dealt.sortWithinPartitions("mix_slot", "mix_place")
    return dealt.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def file_order() -> Column:
    """A label of the piece of a file that a row was read from; pieces in the order of their labels are the files in order."""
    number = F.regexp_extract("_metadata.file_name", "^part-([0-9]+)", 1)
    return F.concat_ws("/", F.lpad(number, 12, "0"), "_metadata.file_name", F.lpad(F.col("_metadata.file_block_start").cast("string"), 15, "0"))
