"""Helpers shared by the operators: scratch tables, checkpoints, let-binding."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters that are not ASCII white space.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


#: Shuffle files go when the write that needed them ends, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Taken from ``spark.checkpoint.dir``.  Only where that is unset (tests on one
    machine) a temporary folder is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("lexiforge.scratch.dir", None)
        if not root:
            root = "file://" + tempfile.mkdtemp(prefix="lexiforge-scratch-")
            spark.conf.set("lexiforge.scratch.dir", root)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared scratch folder and read it back.

    Cuts lineage with files that outlive any executor; the shuffle files of the write are removed with its end.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/lexiforge/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    if (paths := _written.get()) is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """From here on, the session's queries remove their shuffle files when they end, also the write of a result by its caller."""
    spark.conf.set(SHUFFLE_CLEANUP, "true")


@contextmanager
def written() -> Iterator[list[str]]:
    """The paths of the scratch tables that are written inside, in order."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield paths
    finally:
        _written.reset(token)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes scratch tables that nothing reads any more."""
    context = spark.sparkContext
    for p in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def tidy() -> None:
    """Gives freed memory back to the system, so that idle Python workers stay small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidied(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that tidies up after its last one."""

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        tidy()

    return run


def fresh_names(df: DataFrame, n: int) -> list[str]:
    """``n`` column names that ``df`` does not have, whatever their case."""
    taken, found, k = {c.lower() for c in df.columns}, [], 0
    while len(found) < n:
        if f"_c{k}" not in taken:
            found.append(f"_c{k}")
        k += 1
    return found


def smallest(rows: DataFrame, order: str, n: int, slack: float = 1.5) -> list:
    """About the ``n`` rows of the least ``order`` (a double), by a threshold from a first pass, then sorted.

    Partitions send only what lies below the threshold, so the driver gets about
    ``slack * n`` rows however many partitions there are.
    """
    level = rows.agg(F.count("*").alias("n")).first()["n"]
    if level <= 2 * n:
        found = rows.collect()
    else:
        at = rows.agg(F.percentile_approx(order, F.lit(slack * n / level), F.lit(100_000)).alias("q")).first()["q"]
        found = rows.filter(F.col(order) <= at).collect()
    return sorted(found, key=lambda r: (r[order], *map(str, r)))[:n]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    clean = trimmed(text)
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, SPACE_CLASS))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, leaving every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
