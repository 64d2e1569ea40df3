"""Small tables: label dimension, reviewed resolutions, page selections, spans."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.functions.text import casefold_latin, wrap_key

#: A run over part or all of the source: pages and where the outputs go.
PROFILES = {"small": {"pages": "21-30,70,236"}, "full": {"pages": "21-1123"}}
RESOLUTION_COLUMNS = (
    "resolution_key", "previous_line_id", "next_line_id", "left_fragment", "right_fragment",
    "joined_candidate", "hyphenated_candidate", "approved_resolution", "review_status",
)
ACTIONS = ("remove_hyphen", "preserve_hyphen", "leave_unchanged")
SPANS = (
    "page int, line_id string, serial int, col int, line_y double, line_x double, span_ord int, font string, style string, "
    "x0 double, y0 double, x1 double, y1 double, raw_text string, clean_text string"
)


def profile_paths(profile: str, root: str) -> dict[str, str]:
    return {k: f"{root.rstrip('/')}/{profile}/{v}" for k, v in {"markers": "markers.txt", "debug": "debug", "audit": "audit", "archive": "archive"}.items()}


def _csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True, encoding="UTF-8", inferSchema=False)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_tag_map(spark: SparkSession, path: str) -> DataFrame:
    """(tag, tag_rename, color); tags are case-sensitive, the last of duplicates wins."""
    df = _csv(spark, path).withColumn("_o", F.monotonically_increasing_id())
    last = F.max_by(F.struct("tag_rename", "color"), "_o")
    return df.groupBy("tag").agg(last.alias("v")).select("tag", "v.tag_rename", "v.color")


def read_resolutions(spark: SparkSession, path: str) -> DataFrame:
    """Approved rows, after checks of header, keys, duplicates and actions (they raise)."""
    df = _csv(spark, path)
    if missing := sorted(set(RESOLUTION_COLUMNS) - set(df.columns)):
        raise ValueError(f"{path}: missing columns {missing}")
    if df.isEmpty():
        raise ValueError(f"{path}: no rows")
    if bad := resolution_errors(df).take(20):
        raise ValueError(f"{path}: " + "; ".join(f"{r['resolution_key']}: {r['problem']}" for r in bad))
    return approved(df)


def resolution_errors(df: DataFrame) -> DataFrame:
    key = wrap_key(F.col("previous_line_id"), F.col("next_line_id"), F.col("left_fragment"), F.col("right_fragment"))
    wrong = df.filter(casefold_latin(F.col("resolution_key")) != casefold_latin(key)).select("resolution_key", F.lit("key does not match its parts").alias("problem"))
    twice = df.groupBy("resolution_key").count().filter("count > 1").select("resolution_key", F.lit("duplicate key"))
    action = df.filter(_is_approved() & ~F.trim("approved_resolution").isin(*ACTIONS)).select("resolution_key", F.lit("unknown action"))
    return wrong.unionAll(twice).unionAll(action)


def _is_approved() -> Column:
    return F.coalesce(F.lower(F.trim("review_status")) == "approved", F.lit(False))


def approved(df: DataFrame) -> DataFrame:
    return df.filter(_is_approved()).withColumn("approved_resolution", F.trim("approved_resolution"))


def source_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 over the hashes of a source's files in order of their names; the files are hashed in tasks."""
    files = spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("h"))
    return hashlib.sha256("".join(r["h"] for r in files.orderBy("path").collect()).encode()).hexdigest()  # one row per file


def check_source(spark: SparkSession, path: str, pages: DataFrame, pin: str | None = None) -> DataFrame:
    """The spans of ``path``; raises if the file is not the pinned one, lacks a column, or has no span on a selected page."""
    if pin and (found := source_hash(spark, path)) != pin.lower():
        raise ValueError(f"{path}: expected the source {pin}, found {found}")
    spans = spark.read.parquet(path)
    needed = [c.split()[0] for c in SPANS.split(", ")]
    if missing := [c for c in needed if c not in spans.columns and c not in ("style", "y0", "y1")]:
        raise ValueError(f"{path}: missing columns {missing}")
    if spans.join(F.broadcast(pages.select("page")), "page", "left_semi").isEmpty():  # one integer per selected page
        raise ValueError(f"{path}: no span on the selected pages")
    return spans


def page_selection(spark: SparkSession, spec: str, page_count: int) -> DataFrame:
    """Distinct pages of ``"21-30,70"`` within the document, ascending; none is an error."""
    part = F.explode(F.split(F.lit(spec), ",")).alias("part")
    ends = spark.range(1).select(part).select(F.split(F.trim("part"), r"\s*-\s*").alias("e")).filter("e[0] <> ''")
    lo, hi = F.col("e")[0].cast("int"), F.element_at("e", -1).cast("int")
    pages = ends.select(F.explode(F.sequence(F.least(lo, hi), F.greatest(lo, hi))).alias("page")).distinct()
    pages = pages.filter(F.col("page").between(1, page_count)).orderBy("page")
    if pages.isEmpty():
        raise ValueError(f"no page of {spec!r} is in the document")
    return pages
