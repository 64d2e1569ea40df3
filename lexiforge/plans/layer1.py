"""Layer 1 end to end: spans of printed pages to marker text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import clean_layout
from lexiforge.operators import events as ev
from lexiforge.operators import ingest, linewrap, rewrite
from lexiforge.operators.normalize import Rules, normalize
from lexiforge.operators.ordered import number_rows
from lexiforge.operators.reviewed import repair_headwords
from lexiforge.sources.markers import FORM_KINDS, RUN_TYPES
from lexiforge.sources.scratch import cut
from lexiforge.sources.tables import RESOLUTION_COLUMNS


@dataclass
class Pages:
    """The tables of one run; what several of them need is written once."""

    lines: DataFrame
    spans: DataFrame
    decisions: DataFrame
    forms: DataFrame
    events: DataFrame
    markers: DataFrame


def placed_lines(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """Body lines in reading order with entry, form and place in the form."""
    lines = ingest.first_spans(spans)
    lines = lines.withColumn("line_class", ingest.classify(F.col("line_y"), F.col("style"), F.col("x"))).withColumn("_y", F.bround("line_y", 1))
    ordered = number_rows(lines, ["page", "col", "_y", "line_x", "serial"], "pos").drop("_y")
    found = ingest.segment(ordered, pages)
    place = F.row_number().over(Window.partitionBy("form_id").orderBy("pos")) - 1
    return found.withColumn("line_ord", place.cast("int"))


def spans_of_forms(spans: DataFrame, lines: DataFrame) -> DataFrame:
    """Spans with their form; ``join_next``: the line ends in a soft hyphen."""
    keys = lines.select(F.col("page").alias("_p"), F.col("line_id").alias("_id"), "form_id", "line_ord")
    rows = spans.join(keys, (F.col("page") == F.col("_p")) & (F.col("line_id") == F.col("_id")))
    whole = Window.partitionBy("form_id", "line_ord").orderBy("span_ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.last(F.when(ev.shown(F.coalesce("raw_text", F.lit(""))), F.col("raw_text")), ignorenulls=True).over(whole)
    rows = rows.withColumn("join_next", F.coalesce(last.rlike("(?U)­\\s*$"), F.lit(False)))
    return rows.select("form_id", "line_ord", "line_id", "page", "col", "span_ord", "style", "clean_text", "x0", "x1", "join_next")


def wrap_decisions(spans: DataFrame, resolutions: DataFrame | None) -> DataFrame:
    """Line-wrap decisions of all forms, with evidence from all lines."""
    shown = F.when(ev.shown(F.coalesce("clean_text", F.lit(""))), F.struct("span_ord", "clean_text", "style", "x0", "x1"))
    text = F.transform(F.array_sort(F.collect_list(F.struct("span_ord", "clean_text"))), lambda x: x["clean_text"])
    lines = spans.groupBy("form_id", "line_ord", "line_id", "page", "col").agg(F.min(shown).alias("a"), F.max(shown).alias("z"), F.concat_ws("", text).alias("text"))
    lines = cut(lines, "wrapped-lines")
    words, hyphenated = linewrap.word_evidence(lines)
    slim = lines.select(
        "form_id", "line_ord", "line_id", "page", "col", F.col("z.clean_text").alias("last_text"), F.col("z.style").alias("last_style"), F.col("z.x1").alias("last_x1"),
        F.col("a.clean_text").alias("first_text"), F.col("a.style").alias("first_style"), F.col("a.x0").alias("first_x0"),
    )
    if resolutions is None:
        resolutions = spans.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in RESOLUTION_COLUMNS))
    return linewrap.decide(linewrap.candidates(slim), words, hyphenated, resolutions)


def _line(marker: str | Column, value: Column) -> Column:
    return F.struct((F.lit(marker) if isinstance(marker, str) else marker).alias("marker"), clean_layout(value).alias("value"))


def markers_of_events(events: DataFrame) -> DataFrame:
    """(form_id, ord, marker, value) of content events; one that goes on without a blank has a line before it.  Unknown kinds raise."""
    styles = F.create_map(*[F.lit(x) for name, style in RUN_TYPES.items() for x in (style, name)])
    kinds = F.create_map(*[F.lit(x) for pair in (("sense", "Sense"), ("label", "Label"), ("see", "See"), ("see_bare", "SeeBare")) for x in pair])
    marker = F.when(F.col("kind") == "run", F.try_element_at(styles, F.coalesce("style", F.lit("")))).otherwise(F.try_element_at(kinds, F.col("kind")))
    known = F.coalesce(marker, F.raise_error(F.concat(F.lit("unknown event: "), "kind", F.lit(" "), F.coalesce("style", F.lit("")))))
    none = F.lit(None).cast("struct<marker:string,value:string>")
    lines = F.array_compact(F.array(F.when(F.col("boundary") == ev.JOINED, _line("NoSpace", F.lit(""))).otherwise(none), _line(known, F.col("value"))))
    return events.select("form_id", "ord", F.posexplode(lines).alias("k", "x")).select("form_id", (F.col("ord") * 2 + F.col("k")).alias("ord"), "x.marker", "x.value")


def marker_lines(forms: DataFrame, events: DataFrame) -> DataFrame:
    """(form_id, ord, marker, value) of root entries with their forms.

    ``forms``: parsed headers with entry_id, entry_type, form_type, first_text.  An entry without an expression goes with
    all its forms; a derived form without one is shown unparsed.
    """
    root = (F.col("entry_type") == "root") & (F.col("form_type") == "root") & (F.col("expression") != "")
    entries = forms.filter(root).select(F.col("entry_id").alias("_e"))
    own = forms.join(entries, F.col("entry_id") == F.col("_e"), "left_semi")
    is_root, parsed = F.col("form_type") == "root", F.col("expression") != ""
    none = F.lit(None).cast("struct<marker:string,value:string>")
    inline = F.when(F.col("inline_subentry").isNotNull(), F.when(is_root, _line("InlineSubentry", F.col("inline_subentry"))).otherwise(_line("Note", F.concat(F.lit("Inline form: "), "inline_subentry"))))
    head = F.concat(
        F.array(_line(F.when(is_root, "Entry").otherwise("Subentry"), F.col("expression"))), F.transform("variants", lambda v: _line("Variant", v)),
        F.array_compact(F.array(F.when(F.col("homograph").isNotNull(), _line("Homograph", F.col("homograph"))).otherwise(none), inline)),
    )
    lines = F.when(parsed, head).otherwise(F.array(_line("Unparsed", F.col("first_text"))))
    heads = own.select("form_id", F.posexplode(lines).alias("k", "x")).select("form_id", (F.col("k") - (1 << 20)).cast("long").alias("ord"), "x.marker", "x.value")
    content = markers_of_events(events).join(own.filter(parsed).select(F.col("form_id").alias("_f")), F.col("form_id") == F.col("_f"), "left_semi")
    return heads.unionByName(content)


def parse_pages(spans: DataFrame, pages: DataFrame, known: Column, resolutions: DataFrame | None = None, joined_lines: DataFrame | None = None, headwords: DataFrame | None = None, rules: Rules | None = None) -> Pages:
    """From spans (``sources.tables.SPANS``) of the selected ``pages`` to normalised marker lines.

    ``known``: the codes of the label map as an array; ``joined_lines``: line_id of lines reviewed for missing blanks;
    ``headwords``: line_id, headword, variants of lines whose headword was reviewed; ``rules``: tables of the normalisation.
    """
    spans = spans.join(F.broadcast(pages.select("page")), "page")  # one integer per selected page
    variants = None
    if headwords is not None:
        spans = cut(repair_headwords(spans, headwords), "reviewed-spans")
        variants = spans.filter("reviewed_variants is not null").groupBy("line_id").agg(F.first("reviewed_variants").alias("values"))
        spans = spans.drop("reviewed_variants")
    lines = cut(placed_lines(spans, pages), "lines")
    own = cut(spans_of_forms(spans, lines), "spans")
    decisions = cut(wrap_decisions(own, resolutions), "wraps")
    marked = cut(ev.mark_zones(own), "zones")
    first = own.filter("line_ord = 0").groupBy("form_id").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("span_ord", "clean_text"))), lambda x: x["clean_text"])).alias("first_text"))
    meta = lines.groupBy("form_id").agg(F.first("entry_id").alias("entry_id"), F.first("entry_type").alias("entry_type"), F.first("form_type").alias("form_type"))
    if variants is not None:
        heads = lines.filter("line_ord = 0").select("form_id", F.col("line_id").alias("_id"))
        variants = heads.join(variants, F.col("_id") == F.col("line_id")).select("form_id", "values")
    forms = cut(ev.parse_forms(marked, variants).join(meta, "form_id").join(first, "form_id"), "headers")
    if joined_lines is None:
        joined_lines = spans.sparkSession.createDataFrame([], "line_id string")
    content = marked.filter("zone = 'rest'").drop("zone")
    raw = ev.content_events(content, known, decisions.select("form_id", "line_ord", "action"), joined_lines, forms)
    # marker text has a sense's number, however it was printed
    raw = raw.withColumn("value", F.when(F.col("kind") == "sense", F.regexp_replace("value", r"^0+(?=\d)", "")).otherwise(F.col("value")))
    events = cut(rewrite.rewrite_events(cut(raw, "events")), "content")
    raw_lines = number_rows(marker_lines(forms, events), ["form_id", "ord"], "line_no").select("line_no", "marker", "value")
    return Pages(lines, own, decisions, forms, events, normalize(cut(raw_lines, "markers"), rules))


def text_lines(markers: DataFrame) -> DataFrame:
    """(line_no, line): a blank line before each form but the first; trailing white space goes."""
    text = F.regexp_replace(F.concat(F.lit("["), "marker", F.lit("] "), F.coalesce("value", F.lit(""))), r"(?U)\s+$", "")
    opens = F.col("marker").isin(*FORM_KINDS) & (F.col("line_no") > 1)
    both = F.when(opens, F.array(F.lit(""), text)).otherwise(F.array(text))
    return markers.select((F.col("line_no") * 2).alias("_n"), F.posexplode(both).alias("k", "line")).select((F.col("_n") + F.col("k")).alias("line_no"), "line")


def known_codes(tags: DataFrame, most: int = 100_000) -> Column:
    """The label map's codes as one array; the map is a small table by contract, and more than ``most`` rows raise."""
    codes = [r["tag"] for r in tags.select("tag").distinct().orderBy("tag").limit(most + 1).collect()]
    if len(codes) > most:
        raise ValueError(f"the label map has more than {most} codes")
    return F.array(*[F.lit(c) for c in codes]) if codes else F.array().cast("array<string>")


def write_text(spark: SparkSession, markers: DataFrame, path: str) -> None:
    """Marker text as ordered part files below ``path``: ranges of line numbers, sorted inside."""
    lines = text_lines(markers)
    lines.orderBy("line_no").select("line").write.mode("overwrite").text(path)
