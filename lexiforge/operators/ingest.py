"""From span tables of printed pages to entries and forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import near

from .ordered import running_sum

# Anchors and bands of the printed page, in points.
ROOT_X, DERIVED_X = (42.0, 258.0), (48.0, 264.0)
BODY_TOP, BODY_BOTTOM = 50.0, 690.0
SKIPPED = ("running_header", "running_footer", "blank")


def reading_order(lines: DataFrame) -> list[Column]:
    """Sort key of lines: page, column, rounded y, x, serial (the tie-break)."""
    return [F.col("page"), F.col("col"), F.bround("line_y", 1), F.col("line_x"), F.col("serial")]


def first_spans(spans: DataFrame) -> DataFrame:
    """One row per line with style and x of its first meaningful span (null: none)."""
    shown = F.when(F.regexp_replace("clean_text", r"(?U)\s", "") != "", F.struct("span_ord", "style", "x0"))
    return (
        spans.groupBy("page", "line_id", "serial", "col", "line_y", "line_x")
        .agg(F.min(shown).alias("f"))
        .select("page", "line_id", "serial", "col", "line_y", "line_x", F.col("f.style").alias("style"), F.col("f.x0").alias("x"))
    )


def classify(y: Column, style: Column, x: Column) -> Column:
    bold = F.coalesce(style.isin("bold", "bold_italic"), F.lit(False))
    return (
        F.when(y < BODY_TOP, "running_header")
        .when(y > BODY_BOTTOM, "running_footer")
        .when(style.isNull(), "blank")
        .when(bold & near(x, ROOT_X), "root_entry_start")
        .when(bold & near(x, DERIVED_X), "subentry_start")
        .otherwise("continuation")
    )


def segment(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Entries and forms of classified body lines.

    ``lines``: pos (dense reading order), page, line_class; ``pages``: the selected
    pages.  A gap in the selection closes the open entry, so the line after it
    starts an orphan unless it starts a root.  Adds entry_id, form_id, entry_type,
    form_type, partial_start, partial_end.
    """
    # runs of consecutive selected pages: one row per page
    run = pages.select("page", (F.col("page") - F.row_number().over(Window.orderBy("page"))).alias("run"))
    body = lines.filter(~F.col("line_class").isin(*SKIPPED)).join(F.broadcast(run), "page")
    body = running_sum(body, "pos", F.lit(1), "n")
    before = body.select((F.col("n") + 1).alias("_n"), F.col("run").alias("_run"))
    body = body.join(before, F.col("n") == F.col("_n"), "left")
    root = F.col("line_class") == "root_entry_start"
    gap = F.col("_run").isNull() | (F.col("_run") != F.col("run"))
    body = running_sum(body.withColumn("_start", root | gap), "n", F.col("_start"), "entry_id")
    form_start = F.col("_start") | (F.col("line_class") == "subentry_start")
    body = running_sum(body, "n", form_start, "form_id")
    kinds = body.groupBy("entry_id").agg(
        F.min_by("line_class", "n").alias("_first"), F.max("n").alias("_last"), F.max("run").alias("_r"), F.min_by("form_id", "n").alias("_f")
    )
    after = body.filter("_start").select((F.col("n") - 1).alias("_last"), (root & (F.col("_run") == F.col("run"))).alias("_closed"))
    kinds = kinds.join(after, "_last", "left")
    is_root = F.col("_first") == "root_entry_start"
    return (
        body.join(kinds, "entry_id")
        .withColumn("entry_type", F.when(is_root, "root").otherwise("orphan_fragment"))
        .withColumn("form_type", F.when(F.col("form_id") != F.col("_f"), "subentry").when(is_root, "root").otherwise("orphan"))
        .withColumn("partial_start", ~is_root)
        .withColumn("partial_end", ~F.coalesce("_closed", F.lit(False)))
        .drop("_n", "_run", "_start", "_first", "_last", "_r", "_f", "_closed", "run", "n")
    )
