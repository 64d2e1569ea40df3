"""Line-wrap decisions from corpus evidence and reviewed resolutions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.functions.text import casefold_latin, wrap_key

# Edges of the two body columns, in points.
LEFT_EDGE, RIGHT_EDGE, TOLERANCE = (54.0, 270.0), (246.0, 462.0), 2.5


def word_evidence(texts: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct case-folded words, and words joined by a hyphen."""
    words = texts.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    pairs = texts.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(r"(?<!\p{L})\p{L}+-\p{L}+(?!\p{L})"), F.lit(0))).alias("w"))
    return words.select(casefold_latin(F.col("w")).alias("word")).distinct(), pairs.select(casefold_latin(F.col("w")).alias("word")).distinct()


def candidates(lines: DataFrame) -> DataFrame:
    """Pairs of neighbouring lines of a form that may share a wrapped word.

    ``lines``: form_id, line_ord (dense in the form), line_id, page, col,
    last_text, last_style, last_x1, first_text, first_style, first_x0.
    """
    nxt = lines.select(
        F.col("form_id").alias("_f"), (F.col("line_ord") - 1).alias("_o"), F.col("line_id").alias("next_line_id"), F.col("page").alias("_p"), F.col("col").alias("_c"),
        F.col("first_text").alias("_t"), F.col("first_style").alias("_s"), F.col("first_x0").alias("_x"),
    )
    pair = lines.join(nxt, (F.col("form_id") == F.col("_f")) & (F.col("line_ord") == F.col("_o")))
    edge = lambda edges: F.when(F.col("col") == 0, edges[0]).otherwise(edges[1])
    left, right = F.regexp_extract("last_text", r"(?U)(\p{L}+)-\s*$", 1), F.regexp_extract("_t", r"(?U)^\s*(\p{L}+)", 1)
    fits = (F.col("page") == F.col("_p")) & (F.col("col") == F.col("_c")) & (F.col("last_style") == F.col("_s"))
    fits = fits & (F.abs(F.col("last_x1") - edge(RIGHT_EDGE)) <= TOLERANCE) & (F.abs(F.col("_x") - edge(LEFT_EDGE)) <= TOLERANCE)
    found = pair.filter(fits).select("form_id", "line_ord", F.col("line_id").alias("previous_line_id"), "next_line_id", left.alias("left_fragment"), right.alias("right_fragment"))
    return found.filter("left_fragment <> '' and right_fragment <> ''")


def decide(pairs: DataFrame, words: DataFrame, hyphenated: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Adds joined_candidate, hyphenated_candidate, action, source, replacement.

    Precedence: the corpus has it hyphenated; has it joined; reviewed rows.
    """
    p = pairs.withColumn("joined_candidate", F.concat("left_fragment", "right_fragment")).withColumn("hyphenated_candidate", F.concat_ws("-", "left_fragment", "right_fragment"))
    p = p.withColumn("resolution_key", wrap_key(F.col("previous_line_id"), F.col("next_line_id"), F.col("left_fragment"), F.col("right_fragment")))
    p = p.withColumn("_j", casefold_latin(F.col("joined_candidate"))).withColumn("_h", casefold_latin(F.col("hyphenated_candidate")))
    p = p.join(words.select(F.col("word").alias("_j"), F.lit(True).alias("_in")), "_j", "left")
    p = p.join(hyphenated.select(F.col("word").alias("_h"), F.lit(True).alias("_hin")), "_h", "left")
    r = resolutions.select("resolution_key", F.col("joined_candidate").alias("_rj"), F.col("hyphenated_candidate").alias("_rh"), F.col("approved_resolution").alias("_ra"))
    p = p.join(r, "resolution_key", "left")
    differs = (F.col("_rj") != F.col("joined_candidate")) | (F.col("_rh") != F.col("hyphenated_candidate"))
    pick = lambda a, b, c, d, e: F.when(F.col("_hin"), a).when(F.col("_in"), b).when(F.col("_ra").isNull(), c).when(differs, d).otherwise(e)
    lit = F.lit
    p = p.withColumn("action", pick(lit("preserve_hyphen"), lit("remove_hyphen"), lit("ambiguous"), lit("conflict"), F.trim("_ra")))
    p = p.withColumn("source", pick(lit("corpus_hyphenated"), lit("corpus_joined"), lit("unresolved"), lit("manual_csv_mismatch"), lit("manual_csv")))
    shown = F.when(F.col("action") == "remove_hyphen", F.col("joined_candidate")).when(F.col("action") == "preserve_hyphen", F.col("hyphenated_candidate"))
    return p.withColumn("replacement", shown).drop("_j", "_h", "_in", "_hin", "_rj", "_rh", "_ra")


def unmatched(resolutions: DataFrame, decisions: DataFrame) -> DataFrame:
    return resolutions.join(decisions, "resolution_key", "left_anti").select("resolution_key")


def audit(decisions: DataFrame, unmatched_rows: DataFrame) -> DataFrame:
    """One row of counters."""
    actions = ("remove_hyphen", "preserve_hyphen", "leave_unchanged", "ambiguous", "conflict")
    sources = ("corpus_hyphenated", "corpus_joined", "manual_csv", "manual_csv_mismatch", "unresolved")
    counts = [F.count_if(F.col("action") == a).alias(f"n_{a}") for a in actions] + [F.count_if(F.col("source") == s).alias(f"n_{s}") for s in sources]
    counts += [F.count("*").alias("n_candidates"), F.count_if(F.col("action").isin("remove_hyphen", "preserve_hyphen")).alias("n_applied")]
    return decisions.agg(*counts).crossJoin(unmatched_rows.agg(F.count("*").alias("n_unmatched")))  # one row each
