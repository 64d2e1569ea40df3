"""Global sequence operators without a global sort.

Order is a dense integer column; rows are handled in chunks of it, and only one
row per chunk is accumulated globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.sources.scratch import cut

CHUNK = 1 << 16


def running_sum(df: DataFrame, order: str, value: Column, out: str, chunk: int = CHUNK) -> DataFrame:
    """``out``: the sum of ``value`` over all rows up to this one (ties of ``order`` are not allowed)."""
    rows = df.withColumn("_v", value.cast("long")).withColumn("_c", F.floor(F.col(order) / chunk))
    sums = rows.groupBy("_c").agg(F.sum("_v").alias("_s"))
    # one row per chunk
    before = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("_c").alias("_k"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_b"))
    here = Window.partitionBy("_c").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_w", F.sum("_v").over(here)).join(base, F.col("_c") == F.col("_k"))
    return summed.withColumn(out, F.col("_b") + F.col("_w")).drop("_v", "_c", "_k", "_b", "_w")


def number_rows(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """1, 2, 3 … in the given order: sorted ranges, then offsets from their counts."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    split = cut(ranged.withColumn("_p", F.shiftright("_id", 33)).withColumn("_i", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))), "ranges")
    counts = split.groupBy("_p").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("_p").alias("_k"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_b"))  # one row per range
    return split.join(F.broadcast(base), F.col("_p") == F.col("_k")).withColumn(out, F.col("_b") + F.col("_i") + 1).drop("_id", "_p", "_i", "_k", "_b")
