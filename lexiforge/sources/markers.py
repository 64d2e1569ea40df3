"""Marker text: one ``[Marker] value`` per line, blank lines between forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import marker_parts, strip
from lexiforge.sources.scratch import cut

# The marker vocabulary and what each marker contributes.
RUN_TYPES = {"Roman": "roman", "Italic": "italic", "Bold": "bold", "BoldItalic": "bold_italic", "SmallCaps": "small_caps", "Symbol": "symbol"}
ITEM_TYPES = RUN_TYPES | {
    "Sense": "sense", "Label": "label", "See": "see", "SeeBare": "see_bare", "NoSpace": "no_space", "Pronunciation": "pronunciation",
    "Expansion": "expansion", "Definition": "roman", "Example": "italic", "Translation": "roman", "Unparsed": "roman", "Note": "note",
}
FORM_KINDS = {"Entry": "entry", "Subentry": "subentry", "InlineSubentry": "inline_subentry"}
HEADERS = ("Variant", "Homograph")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of text files that are split anywhere; parts of a folder follow one another by name.

    A split knows its file and where it begins, so a line's number is the count of lines in the splits before it plus its
    place in its own: one row per split is summed in order, and no file is ever in one row or one task.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select(F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_from"))
    lines = cut(lines.withColumn("_id", F.monotonically_increasing_id()), "marker-lines")
    splits = lines.groupBy("_file", "_from").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_file", "_from").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    base = splits.select(F.col("_file").alias("_f"), F.col("_from").alias("_s"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = lines.join(F.broadcast(base), (F.col("_file") == F.col("_f")) & (F.col("_from") == F.col("_s")))
    return placed.select((F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "line")


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, marker, value) of the non-blank lines of one document (a file or a folder of parts), in its own numbering."""
    return markers_of(numbered_lines(spark, path))


def markers_of(lines: DataFrame) -> DataFrame:
    """Parse (line_no, line); other columns pass through."""
    kept = lines.filter(strip(F.col("line")) != "").withColumn("_m", marker_parts(F.col("line")))
    rest = [c for c in lines.columns if c != "line"]
    return kept.select(*rest, F.col("_m.marker").alias("marker"), F.col("_m.value").alias("value"))


def marker_errors(markers: DataFrame) -> DataFrame:
    """(line_no, problem) of every violation of the grammar."""
    known = [*ITEM_TYPES, *FORM_KINDS, *HEADERS]
    first = markers.filter("marker = 'Entry'").agg(F.min("line_no").alias("first"))
    numbered = F.col("marker").startswith("Definition ")
    problem = (
        F.when(F.col("marker") == "", "line does not start with a marker")
        .when((F.col("line_no") < F.col("first")) | F.col("first").isNull(), "marker before the first entry")
        .when((F.col("marker") == "Sense") & ~F.col("value").rlike("^[0-9]+$"), "invalid sense number")
        .when(numbered & ~F.col("marker").rlike("^Definition [0-9]+$"), "invalid marker")
        .when(~numbered & ~F.col("marker").isin(known), "unknown marker")
    )
    return markers.crossJoin(F.broadcast(first)).select("line_no", problem.alias("problem")).filter("problem is not null")  # one row


def write_lines(content: DataFrame) -> DataFrame:
    """(line_no, line) from (line_no, marker, value): trailing white space goes."""
    return content.select("line_no", F.regexp_replace(F.concat(F.lit("["), "marker", F.lit("] "), F.coalesce("value", F.lit(""))), r"(?U)\s+$", "").alias("line"))
