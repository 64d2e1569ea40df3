"""Greedy packing of ordered rows into components below a byte limit, in parallel.

A bank that begins at a row ends where prefix sums say, so what a run of rows does
depends only on the bytes already in the open bank.  Rows are sorted into ranges
and cut into chunks of some limits' bytes; a chunk becomes a map: for each row that
may begin its first bank, how many banks begin from there on and how full the last
one is.  Maps of ``FAN`` consecutive chunks are composed, level by level, and the
way back down gives every chunk its bank number and fill.  No task holds more than
a chunk or ``FAN`` maps; a map has the rows of one limit's bytes at most.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.sources.scratch import cut

BRACKETS, SEPARATOR = 3, 1
DEFAULT_LIMIT = 8_000_000
LIMITS, FAN = 8, 64  # of a chunk's bytes; of maps in a composition
_MAP = "ends binary, banks binary, fill binary, total long"


class Run:
    """What a run of rows does to the bank that is open before it."""

    def __init__(self, ends: np.ndarray, banks: np.ndarray, fill: np.ndarray, total: int):
        #: per row that may begin the first bank: bytes with it, banks begun from it on, bytes in the last of them
        self.ends, self.banks, self.fill, self.total = ends, banks, fill, total

    @classmethod
    def of_rows(cls, sizes: np.ndarray, limit: int) -> Run:
        p = np.concatenate(([0], np.cumsum(sizes.astype(np.int64) + SEPARATOR)))
        starts = _next_starts(p, limit).tolist()
        base = (BRACKETS - SEPARATOR + p[-1] - p[:-1]).tolist()
        banks, fill = [1] * len(sizes), base
        for i in range(len(sizes) - 1, -1, -1):
            if (j := starts[i]) < len(sizes):
                banks[i], fill[i] = banks[j] + 1, fill[j]
        k = int(np.searchsorted(p[:-1], limit, "left"))  # a bank open before is full by then
        return cls(p[1 : k + 1], np.array(banks[:k], np.int64), np.array(fill[:k], np.int64), int(p[-1]))

    def after(self, used: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(banks begun, fill) for banks that hold ``used`` bytes before the run."""
        fits = used + self.total < limit
        k = np.minimum(np.searchsorted(self.ends, limit - used, "left"), max(len(self.ends) - 1, 0))
        return np.where(fits, 0, self.banks[k]), np.where(fits, used + self.total, self.fill[k])

    def then(self, other: Run, limit: int) -> Run:
        more, fill = other.after(self.fill, limit)
        own = Run(self.ends, self.banks + more, fill, self.total + other.total)
        if self.total < limit:  # the first bank may begin in the other run
            k = int(np.searchsorted(self.total + np.concatenate(([0], other.ends[:-1])), limit, "left"))
            own.ends = np.concatenate((own.ends, self.total + other.ends[:k]))
            own.banks, own.fill = np.concatenate((own.banks, other.banks[:k])), np.concatenate((own.fill, other.fill[:k]))
        return own

    def row(self) -> tuple[bytes, bytes, bytes, int]:
        return self.ends.tobytes(), self.banks.tobytes(), self.fill.tobytes(), self.total

    @classmethod
    def read(cls, r) -> Run:  # noqa: ANN001  a row with the columns of a map
        return cls(*(np.frombuffer(b, np.int64) for b in (r.ends, r.banks, r.fill)), r.total)


def _next_starts(p: np.ndarray, limit: int) -> np.ndarray:
    """For a bank begun at each row the row that begins the next one."""
    return np.searchsorted(p, p[:-1] + limit - (BRACKETS - SEPARATOR), "left") - 1


def _starts(p: np.ndarray, used: int, limit: int) -> list[int]:
    """The rows of a chunk that begin banks; ``used`` is 0 where no bank is open."""
    n, jumps = len(p) - 1, _next_starts(p, limit)
    at = 0 if not used else int(np.searchsorted(p[1:], limit - used, "left"))
    out = []
    while at < n:
        out.append(at)
        at = int(jumps[at])
    return out


def pack(rows: DataFrame, order: str, size: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Adds ``bank`` (from 1): a bank opens when the next row would reach the limit.

    ``order`` is an integer without ties or nulls.  A row that fits no bank raises; a null size is no bytes; no rows, no banks.
    """
    slim = rows.select(F.col(order).cast("long").alias("_o"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_s"))
    slim = slim.withColumn("_s", F.when(F.col("_s") + BRACKETS < limit, F.col("_s")).otherwise(F.raise_error(F.concat(F.lit("a row exceeds the component limit: "), F.col("_s").cast("string")))))
    ranged = slim.repartitionByRange("_o").sortWithinPartitions("_o").withColumn("_p", F.spark_partition_id())
    ranged = cut(ranged, "packed-ranges")
    before = F.sum(F.col("_s") + SEPARATOR).over(Window.partitionBy("_p").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1))
    chunked = cut(ranged.withColumn("_c", F.floor(F.coalesce(before, F.lit(0)) / (LIMITS * limit)).cast("long")), "packed-chunks")

    def mapped(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows.sort_values("_o")["_s"].to_numpy()
        return pd.DataFrame([(int(key[0]), int(key[1]), *Run.of_rows(sizes, limit).row())], columns=["_p", "_c", "ends", "banks", "fill", "total"])

    maps = cut(chunked.groupBy("_p", "_c").applyInPandas(mapped, f"_p long, _c long, {_MAP}"), "packed-maps")
    # chunks are few: their numbers come from the counts of the ranges
    counts = maps.groupBy("_p").agg(F.count("*").alias("n"))
    first = counts.select(F.col("_p").alias("_r"), F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    level = cut(maps.join(F.broadcast(first), F.col("_p") == F.col("_r")).withColumn("k", F.col("_b") + F.col("_c")).drop("_r", "_b"), "packed-numbered")  # one row a range
    numbers = level.select(F.col("_p").alias("_np"), F.col("_c").alias("_nc"), "k")
    levels = [level.select("k", "ends", "banks", "fill", "total")]
    n = level.count()

    def composed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        runs = [Run.read(r) for r in part.sort_values("k").itertuples()]
        out = runs[0]
        for r in runs[1:]:
            out = out.then(r, limit)
        return pd.DataFrame([(int(key[0]), *out.row())], columns=["k", "ends", "banks", "fill", "total"])

    while n > FAN:
        grouped = levels[-1].groupBy(F.floor(F.col("k") / FAN).cast("long").alias("g"))
        levels.append(cut(grouped.applyInPandas(composed, f"k long, {_MAP}"), "packed-level"))
        n = -(-n // FAN)

    def entered(key: tuple, part: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        """Fill and bank number before each of the runs composed into one."""
        used, bank = (int(state["used"].iloc[0]), int(state["bank"].iloc[0])) if len(state) else (0, 0)
        out = []
        for r in part.sort_values("k").itertuples():
            out.append((r.k, used, bank))
            run = Run.read(r)
            if not used:  # the first run of all: its first row begins a bank
                more, used = int(run.banks[0]), int(run.fill[0])
            else:
                a, b = run.after(np.array([used]), limit)
                more, used = int(a[0]), int(b[0])
            bank += more
        return pd.DataFrame(out, columns=["k", "used", "bank"])

    found = rows.sparkSession.createDataFrame([(0, 0, 0)], "k long, used long, bank long")
    for table in reversed(levels):
        below = table.groupBy(F.floor(F.col("k") / FAN).cast("long").alias("g")).cogroup(found.withColumnRenamed("k", "g").groupBy("g"))
        found = cut(below.applyInPandas(lambda key, part, state: entered(key, part, state) if len(part) else pd.DataFrame({"k": [], "used": [], "bank": []}), "k long, used long, bank long"), "packed-entered")
    states = numbers.join(found, "k").select("_np", "_nc", "used", "bank")

    def place(key: tuple, rows: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_o")
        p = np.concatenate(([0], np.cumsum(rows["_s"].to_numpy() + SEPARATOR)))
        begun = np.zeros(len(rows), np.int64)
        begun[_starts(p, int(state["used"].iloc[0]), limit)] = 1
        return pd.DataFrame({"_o": rows["_o"], "bank": int(state["bank"].iloc[0]) + np.cumsum(begun)})

    banks = chunked.groupBy("_p", "_c").cogroup(states.withColumnsRenamed({"_np": "_p", "_nc": "_c"}).withColumn("_p", F.col("_p").cast("int")).groupBy("_p", "_c")).applyInPandas(place, "_o long, bank long")
    return rows.join(banks, F.col(order) == F.col("_o")).drop("_o")


def bank_sizes(packed: DataFrame, size: str) -> DataFrame:
    """(bank, n_rows, n_bytes) as they will be written."""
    n = F.count("*")
    return packed.groupBy("bank").agg(n.alias("n_rows"), (F.sum(size) + (n - 1) * SEPARATOR + BRACKETS).alias("n_bytes"))


def fixed_banks(rows: DataFrame, number: str, per_bank: int = 10_000) -> DataFrame:
    """Banks of a fixed number of rows (``number`` counts from 1)."""
    return rows.withColumn("bank", F.floor((F.col(number) - 1) / per_bank).cast("long") + 1)


__all__ = ["BRACKETS", "DEFAULT_LIMIT", "SEPARATOR", "Run", "bank_sizes", "fixed_banks", "pack"]
