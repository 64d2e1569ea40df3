"""Operators driven by reviewed tables: the rules come as small tables or parameters.

Lines: form_id, ord, marker, value; the first line of a form is its header.  A
table of rules is broadcast only up to ``SMALL`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import clean_text, strip
from lexiforge.sources.markers import HEADERS

SMALL = 100_000


def _rules(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= SMALL else table


def tag_codes(c: Column, known: Column) -> Column:
    """Codes of a label: the whole text without brackets, else its words if all are known, else none."""
    whole = strip(F.regexp_replace(strip(c), r"^[()\[\]]+|[()\[\]]+$", ""))
    words = F.filter(F.split(whole, r"(?U)\s+"), lambda w: w != "")
    every = (F.size(words) > 0) & F.forall(words, lambda w: F.array_contains(known, w))
    return F.when(F.array_contains(known, whole), F.array(whole)).when(every, words).otherwise(F.array().cast("array<string>"))


def joins_bold(c: Column) -> Column:
    """Whether text between bold forms is a mere connector (a conjunction or a mark)."""
    bare = F.regexp_replace(F.lower(clean_text(c)), r"^[\[\]()]+|[\[\]()]+$", "")
    return bare.rlike(r"^(?:(?:,\s*)?(?:and|or)|and/or|[/&,;:.])?$")


def header_connector(c: Column) -> Column:
    """Whether roman header text may stand between observed bold forms: also what ends in a conjunction, or /speech/."""
    text = clean_text(c)
    return (text == "") | joins_bold(c) | text.rlike(r"(?i)(?:^|[\s\[])(?:and(?:/or)?|or)\s*$") | text.rlike(r"^/[^/]+/$")


def root_entries(entries: DataFrame) -> DataFrame:
    """Entries (entry_type, n_forms, expression) that are roots with forms and an expression."""
    return entries.filter((F.col("entry_type") == "root") & (F.col("n_forms") > 0) & (F.coalesce("expression", F.lit("")) != ""))


def mark_joined_spans(spans: DataFrame, line_ids: DataFrame, gap: float = 0.8) -> DataFrame:
    """Adds join_previous: spans of reviewed lines that go on a word or number without a blank.

    ``spans``: line_id, span_ord, clean_text, x0, x1; ``line_ids``: line_id.
    """
    w = Window.partitionBy("line_id").orderBy("span_ord")
    reviewed = spans.join(_rules(line_ids.select("line_id", F.lit(True).alias("_r")).distinct()), "line_id", "left")
    return reviewed.withColumn("join_previous", joins_previous(F.col("_r"), w, gap)).drop("_r")


def joins_previous(reviewed: Column, line: Window, gap: float = 0.8) -> Column:
    """Whether a span of a reviewed line (a window in its order) goes on a word or number without a blank."""
    left, right = F.lag("clean_text").over(line), F.col("clean_text")
    last, first = F.right(left, F.lit(1)), F.left(right, F.lit(1))
    lexical = F.when(last == ".", first.rlike(r"\p{Nd}")).otherwise(last.rlike(r"[\p{L}\p{N}'’]"))
    joined = reviewed & (F.col("x0") - F.lag("x1").over(line) <= gap) & first.rlike(r"[\p{L}\p{N}]") & lexical
    return F.coalesce(joined, F.lit(False))


def reviewed_lines(lines: DataFrame, line_ids: DataFrame) -> DataFrame:
    """The rows of ``lines`` (one a line) that ``line_ids`` lists."""
    return lines.join(_rules(line_ids.select("line_id").distinct()), "line_id", "left_semi")


def repair_headwords(spans: DataFrame, table: DataFrame) -> DataFrame:
    """The reviewed headword of a line is set in bold, cut out of the spans it crosses; adds reviewed_variants (null: none).

    ``spans``: line_id, span_ord, style, clean_text, raw_text, x0, x1; ``table``: line_id, headword, variants, one row per
    line.  The headword is the evidence: a line that does not begin with it raises with its name, and so does a line that the
    table names twice.  Pieces keep their part of the raw text where it is as long, and of the box by their length.
    """
    rules = table.groupBy(F.col("line_id").alias("_id")).agg(F.first("headword").alias("_word"), F.first("variants").alias("reviewed_variants"), F.count("*").alias("_n"))
    w = Window.partitionBy("line_id").orderBy("span_ord")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = spans.withColumn("clean_text", F.coalesce("clean_text", F.lit(""))).join(_rules(rules), F.col("line_id") == F.col("_id"), "left")
    rows = rows.withColumn("_from", F.coalesce(F.sum(F.length("clean_text")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # only what stands at the headword's place is gathered, so a line's spans never hold the whole line each
    lead = F.length(F.regexp_extract("clean_text", r"(?U)^\s*", 0))
    rows = rows.withColumn("_lead", F.min(F.when(lead < F.length("clean_text"), F.col("_from") + lead)).over(whole)).withColumn("_all", F.sum(F.length("clean_text")).over(whole))
    start = F.coalesce("_lead", "_all")
    skip = F.greatest(start - F.col("_from"), F.lit(0))
    own = F.substring(F.col("clean_text"), (skip + 1).cast("int"), (start + F.length("_word") - F.col("_from") - skip).cast("int"))
    rows = rows.withColumn("_found", F.collect_list(F.when(F.col("_id").isNotNull() & (own != ""), own)).over(whole))
    found = F.concat_ws("", "_found")
    why = F.concat(F.lit("headword evidence changed for "), "line_id", F.lit(": expected "), "_word", F.lit(", got "), found)
    twice = F.concat(F.lit("two headwords for "), "line_id")
    checked = F.when(F.col("_id").isNull(), F.lit(None).cast("int")).when(F.col("_n") > 1, F.raise_error(twice).cast("int")).when(found != F.col("_word"), F.raise_error(why).cast("int")).otherwise(start)
    rows = rows.withColumn("_start", checked).withColumn("_size", F.length("clean_text"))
    # places inside the span where it is cut
    inside = lambda c: F.least(F.greatest(c - F.col("_from"), F.lit(0)), F.col("_size")).cast("long")
    ends = F.array(F.lit(0).cast("long"), inside(F.col("_start")), inside(F.col("_start") + F.length("_word")), F.col("_size").cast("long"))
    cuts = F.array_distinct(F.when(F.col("_id").isNull(), F.array(F.lit(0).cast("long"), F.col("_size").cast("long"))).otherwise(ends))
    rows = rows.withColumn("_cuts", F.when(F.col("_size") == 0, F.array(F.lit(0).cast("long"), F.lit(0).cast("long"))).otherwise(cuts))
    pieces = F.transform(F.sequence(F.lit(1), F.size("_cuts") - 1), lambda k: F.struct(F.get("_cuts", k - 1).alias("a"), F.get("_cuts", k).alias("b")))
    rows = rows.select("*", F.posexplode(pieces).alias("_k", "_p"))
    part = lambda c: F.substring(F.col(c), F.col("_p.a") + 1, F.col("_p.b") - F.col("_p.a"))
    bold = (F.col("_from") + F.col("_p.a") < F.col("_start") + F.length("_word")) & (F.col("_from") + F.col("_p.b") > F.col("_start")) & (F.col("_size") > 0)
    at = lambda c: F.when(F.col("_size") == 0, F.when(c == F.col("_p.a"), F.col("x0"))).otherwise(F.round(F.col("x0") + (F.col("x1") - F.col("x0")) * c / F.col("_size"), 4))
    touched = F.size("_cuts") > 2
    new = {
        "style": F.when(F.coalesce(bold, F.lit(False)), "bold").otherwise(F.col("style")),
        "raw_text": F.when(touched & (F.length("raw_text") == F.col("_size")), part("raw_text")).otherwise(F.col("raw_text")),
        "x0": F.when(touched, at(F.col("_p.a"))).otherwise(F.col("x0")),
        "x1": F.when(touched, at(F.col("_p.b"))).otherwise(F.col("x1")),
        "clean_text": part("clean_text"),
        "span_ord": (F.col("span_ord") * 4 + F.col("_k")).cast("int"),
    }
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in spans.columns], "reviewed_variants")


def repair_variants(lines: DataFrame, repairs: DataFrame, false_values: tuple[str, ...] = ()) -> DataFrame:
    """Variants replaced by form, and false ones removed.

    ``repairs``: expression, replaced (array), replacements (array).  Replacements
    that the form lacks come where its first replaced variant stood, else after its
    variants and homograph number.  Of rules with one expression the least counts.
    """
    w = Window.partitionBy("form_id").orderBy("ord")
    whole = Window.partitionBy("form_id")
    variant = F.col("marker") == "Variant"
    table = repairs.groupBy(F.col("expression").alias("_e")).agg(F.min(F.struct("replaced", "replacements")).alias("r")).select("_e", "r.replaced", "r.replacements")
    body = F.sum((~F.col("marker").isin(*HEADERS)).cast("int")).over(w)  # 1 for the header and the lines that describe it
    rows = lines.withColumn("_head", F.first("value").over(w)).withColumn("_body", body)
    rows = rows.join(_rules(table), F.col("_head") == F.col("_e"), "left")
    hit = F.coalesce(variant & F.array_contains("replaced", F.col("value")), F.lit(False))
    rows = rows.withColumn("_hit", hit)
    own = F.collect_set(F.when(variant, F.col("value"))).over(whole)
    at = F.coalesce(F.min(F.when(F.col("_hit"), F.col("ord"))).over(whole), F.max(F.when(F.col("_body") == 1, F.col("ord"))).over(whole))
    rows = rows.withColumn("_new", F.when(F.col("_e").isNotNull() & (F.col("ord") == at), F.array_except("replacements", own)))
    gone = F.col("_hit") | (variant & F.col("value").isin(*false_values) if false_values else F.lit(False))
    line = lambda m, v: F.struct(m.alias("marker"), v.alias("value"))
    kept = F.when(gone, F.array().cast("array<struct<marker:string,value:string>>")).otherwise(F.array(line(F.col("marker"), F.col("value"))))
    added = F.transform(F.coalesce("_new", F.array().cast("array<string>")), lambda v: line(F.lit("Variant"), v))
    out = rows.select("form_id", "ord", F.posexplode(F.concat(kept, added)).alias("k", "x"))
    number = F.row_number().over(Window.partitionBy("form_id").orderBy("ord", "k")) - 1
    return out.select("form_id", number.cast("long").alias("ord"), "x.marker", "x.value")


def promote_inline_subentries(lines: DataFrame, table: DataFrame) -> DataFrame:
    """Bold runs that ``table`` (root, value) lists for their entry become inline subentries; a number after them a sense.

    ``lines`` of whole entries: form_id is the entry's.
    """
    w = Window.partitionBy("form_id").orderBy("ord")
    root = F.last(F.when(F.col("marker") == "Entry", F.col("value")), ignorenulls=True).over(w)
    numbered = r"(?sU)^(.+?)\s+(\d{1,2})$"
    bold = F.col("marker").isin("Bold", "BoldItalic")
    plain = F.when(F.col("value").rlike(numbered), F.regexp_extract("value", numbered, 1)).otherwise(F.col("value"))
    rows = lines.withColumn("_root", root).withColumn("_plain", F.when(bold, plain))
    rules = table.select(F.col("root").alias("_tr"), F.col("value").alias("_tv")).distinct()
    rows = rows.join(_rules(rules), (F.col("_root") == F.col("_tr")) & (F.col("_plain") == F.col("_tv")), "left")
    line = lambda m, v: F.struct(m.alias("marker"), v.alias("value"))
    sub = line(F.lit("InlineSubentry"), F.col("_plain"))
    both = F.array(sub, line(F.lit("Sense"), F.regexp_extract("value", numbered, 2)))
    new = F.when(F.col("_tr").isNull(), F.array(line(F.col("marker"), F.col("value")))).when(F.col("value").rlike(numbered), both).otherwise(F.array(sub))
    out = rows.select("form_id", "ord", F.posexplode(new).alias("k", "x"))
    return out.select("form_id", (F.col("ord") * 2 + F.col("k")).alias("ord"), "x.marker", "x.value")
