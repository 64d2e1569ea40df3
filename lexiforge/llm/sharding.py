"""Sharding by sampled splitters.

Records are ordered by a key (hash of the text, then id), so equal texts are
neighbours.  A size-weighted sample of keys gives quantile boundaries; records are
range-partitioned by them, and ranges that turn out overfull are subdivided with
splitters sampled inside them.  Exact byte and row prefix sums over the ranges then
cut the order into shards of near equal bytes.

A record above a ``HEAVY``-th of the mean shard would tilt a cut, so these (fewer than
``HEAVY * shards`` whatever the input) are dealt first, the largest to the emptiest
shard; the order of the others fills all shards up to one level.  A record goes
where its middle falls.  So the shards that the level reaches differ by less than
two light records, a sixteenth of the mean; a shard lies above the level only by
heavy records that could not be dealt better, by less than the last one it got.
Only the sample, the heavy sizes and one row per range reach the driver or a
broadcast: about ``sample_per_range`` keys for each range of ``range_bytes``.

Edge cases: a null text counts as no bytes (its record still weighs ``overhead``);
equal light texts stay in one shard unless a shard boundary falls inside the group, so
a hot group of copies is spread over as many shards as its bytes need; identical
rows are interchangeable; an empty table gives an empty result; extra columns
pass through, also such with the names of the columns added (these are replaced) and any others.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVERHEAD = 16
#: Beyond a TB ranges get larger instead of more; a task sorts its range with spilling.
MOST_RANGES = 16384
#: A record above this part of the mean shard is dealt by itself.
HEAVY = 32


def _sample(keyed: DataFrame, n: int) -> list[tuple[int, int]]:
    """Size-weighted keys: each is drawn with a chance in proportion to its size, so about ``n`` reach the driver.

    A record that weighs more than ``1 / n`` of all is drawn for sure.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    u = (F.xxhash64("h", "d", F.lit(7)).cast("double") / F.lit(2.0**64)) + F.lit(0.5)
    drawn = keyed.filter(u * total < F.col("size") * float(n)).select("h", "d").distinct()
    return [(r["h"], r["d"]) for r in drawn.collect()]


def _quantiles(keys: list[tuple[int, int]], ranges: int) -> list[tuple[int, int]]:
    keys = sorted(set(keys))
    step = len(keys) / max(ranges, 1)
    return sorted({keys[int(i * step)] for i in range(1, ranges) if int(i * step) < len(keys)}) if keys else []


def _range_of(bounds: list[tuple[int, int]]) -> Column:
    """Index of the range of a key: a binary search over constant boundaries."""
    if not bounds:
        return F.lit(0)
    # two parallel arrays of longs fold into literals, so a probe is two lookups
    hs, ds = F.lit([h for h, _ in bounds]), F.lit([d for _, d in bounds])
    top = 1
    while top * 2 <= len(bounds):
        top *= 2
    steps = []
    while top:
        steps.append(top)
        top //= 2

    def step(lo: Column, s: Column) -> Column:
        h, d = F.get(hs, lo + s - 1), F.get(ds, lo + s - 1)
        below = (h < F.col("h")) | ((h == F.col("h")) & (d <= F.col("d")))
        return F.when(F.coalesce(below, F.lit(False)), lo + s).otherwise(lo)

    return F.aggregate(F.lit(steps), F.lit(0), step)


def _deal(heavy: list, shards: int) -> tuple[list[tuple], list[int], list[int]]:
    """(h, d, size, nth, shard, slot) of the heavy records, largest to the emptiest shard; bytes and rows of each shard."""
    load, rows, out = [(0, s) for s in range(shards)], [0] * shards, []
    for r in sorted(heavy, key=lambda r: (-r["size"], r["h"], r["d"])):
        for nth in range(1, r["n"] + 1):
            used, s = heapq.heappop(load)
            out.append((r["h"], r["d"], r["size"], nth, s, rows[s]))
            rows[s] += 1
            heapq.heappush(load, (used + r["size"], s))
    return out, [used for used, _ in sorted(load, key=lambda x: x[1])], rows


def _room(loads: list[int], light: int) -> list[int]:
    """Light bytes for each shard such that all shards they reach end at one level."""
    below, level = sorted(loads), 0
    for k in range(1, len(below) + 1):
        level = (light + sum(below[:k])) / k
        if k == len(below) or level <= below[k]:
            break
    ends = [round(x) for x in accumulate(max(0.0, level - x) for x in loads)]
    return [b - a for a, b in zip([0, *ends], ends)]  # noqa: B905


def _passed(bounds: list[int], x: Column) -> Column:
    """How many of the sorted ``bounds`` are at most ``x``, by binary search."""
    if not bounds:
        return F.lit(0)
    values, steps = F.lit(bounds), [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.lit(steps), F.lit(0), lambda lo, s: F.when(F.coalesce(F.get(values, lo + s - 1) <= x, F.lit(False)), lo + s).otherwise(lo))


def shard(
    records: DataFrame,
    shards: int = 40,
    *,
    size: Column | None = None,
    group: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_per_range: int = 16,
    range_bytes: int = 64 << 20,
    ranges: int | None = None,
    rounds: int = 2,
) -> DataFrame:
    """Adds ``size``, ``shard`` and ``slot`` (gapless from 0 in each shard) to ``records``.

    Law: sizes near equal, as bounded above.  The number of ranges follows the bytes
    (``range_bytes`` each; six a shard at least).
    """
    size = size if size is not None else F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + OVERHEAD
    group = group if group is not None else F.xxhash64(F.col(text_col))
    rest = [c for c in records.columns if c.lower() not in ("size", "shard", "slot")]
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(id_col).cast("string")))
    row = F.struct(*[F.col(c).alias(f"r{i}") for i, c in enumerate(rest)])
    keyed = records.select(row.alias("row"), size.cast("long").alias("size"), group.alias("h"), key.alias("d"))
    total = keyed.agg(F.sum("size")).first()[0] or 0
    ranges = ranges or min(max(6 * shards, -(-total // range_bytes)), MOST_RANGES)
    weighty = F.col("size") * (HEAVY * shards) > total
    every, keyed = keyed, keyed.filter(~weighty)
    dealt, loads, rows = _deal(every.filter(weighty).groupBy("h", "d", "size").agg(F.count("*").alias("n")).collect(), shards)
    total -= sum(loads)
    bounds = _quantiles(_sample(keyed, sample_per_range * ranges), ranges)
    for _ in range(rounds):
        ranged = keyed.select("size", "h", "d", _range_of(bounds).alias("r"))
        weights = ranged.groupBy("r").agg(F.sum("size").alias("b"), F.min(F.struct("h", "d")).alias("lo"), F.max(F.struct("h", "d")).alias("hi")).collect()
        overfull = [r["r"] for r in weights if r["b"] > 2.5 * total / ranges and r["lo"] != r["hi"]]
        if not overfull:
            break
        inside = ranged.filter(F.col("r").isin(overfull))
        bounds = sorted({*bounds, *_quantiles(_sample(inside, sample_per_range * 4 * len(overfull)), 4 * len(overfull))})
    ranged = keyed.withColumn("r", _range_of(bounds)).repartition("r")
    sums = ranged.groupBy("r").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    spark, at, base = records.sparkSession, [0, 0], []
    for r in sorted(sums, key=lambda r: r["r"]):  # one row per range
        base.append((r["r"], at[0], at[1]))
        at = [at[0] + r["b"], at[1] + r["n"]]
    columns = [F.col(f"row.r{i}").alias(c) for i, c in enumerate(rest)]
    places = spark.createDataFrame(dealt, "hh long, dd long, ss long, nth int, shard int, slot long")  # fewer than HEAVY * shards
    nth = F.row_number().over(Window.partitionBy("h", "d", "size").orderBy(F.xxhash64(F.to_json("row"))))
    heavy = every.filter(weighty).withColumn("k", nth).join(F.broadcast(places), (F.col("h") == F.col("hh")) & F.col("d").eqNullSafe(F.col("dd")) & (F.col("size") == F.col("ss")) & (F.col("k") == F.col("nth")))
    heavy = heavy.select(*columns, "size", "shard", "slot")
    if not base:
        return heavy
    starts = spark.createDataFrame(base, "r int, b long, n long")
    order = Window.partitionBy("r").orderBy("h", "d")
    placed = (
        ranged.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rank", F.row_number().over(order))
        .join(F.broadcast(starts) if len(base) <= 100_000 else starts, "r")
    )
    ends = [2 * x for x in accumulate(_room(loads, total))][:-1]
    placed = placed.select("row", "size", _passed(ends, 2 * (F.col("b") + F.col("upto")) - F.col("size")).alias("shard"), (F.col("n") + F.col("rank") - 1).alias("g"))
    held = spark.createDataFrame(list(enumerate(rows)), "shard int, held long")
    first = placed.groupBy("shard").agg(F.min("g").alias("first")).join(F.broadcast(held), "shard")
    placed = placed.join(F.broadcast(first), "shard")  # one row per shard
    return placed.select(*columns, "size", "shard", (F.col("g") - F.col("first") + F.col("held")).cast("long").alias("slot")).union(heavy)


def op5_sharding(docs: DataFrame) -> DataFrame:
    """Documents into shards 0 to 39 under the law ``bytes``."""
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD).alias("_bytes"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("_key"),
    )
    return shard(slim, 40, size=F.col("_bytes"), group=F.col("_key")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
