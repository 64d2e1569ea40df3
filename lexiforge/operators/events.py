"""From the spans of forms to headers and content events.

Spans: form_id, line_ord (from 0 in the form), line_id, span_ord, style, clean_text,
x0, x1, join_next (the line goes on without a blank).  Everything is windows inside
a form or a line of it, so one exchange by form serves all steps; a form is bounded
by the printed page, however many forms there are.

What a greedy walk from left to right would find is stated as conditions on rows:
a prefix ends at the first row that is not accepted, a chain is an island of linked
rows.  Blank spans are looked through but keep their place.

Defined cases: a null text is empty and gives no event; a form without a bold span
has an empty header and all its spans as content; ties of (line_ord, span_ord) are
not allowed; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import clean_layout, parse_expression, strip, valid_roman

from .reviewed import header_connector, joins_previous, reviewed_lines, tag_codes

SENSE = r"(?U)^\s*\d+\s*$"
APPLIED = ("remove_hyphen", "preserve_hyphen")
#: Boundary of an event that goes on its neighbour of another style without a blank.
JOINED = "\u2060"
_UPTO, _BEFORE = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)


def _line() -> Window:
    return Window.partitionBy("form_id", "line_ord").orderBy("span_ord")


def _back() -> Window:
    return Window.partitionBy("form_id", "line_ord").orderBy(F.desc("span_ord"))


def _whole() -> Window:
    return Window.partitionBy("form_id", "line_ord")


def shown(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s", "") != ""


def _bold(c: Column) -> Column:
    return c.isin("bold", "bold_italic")


def _italic(c: Column) -> Column:
    return c.isin("italic", "bold_italic")


def _previous(fields: list[str], frame: Window | None = None) -> Column:
    """The nearest span before that is not blank."""
    return F.last(F.when(F.col("_shown"), F.struct(*fields)), ignorenulls=True).over((frame or _line()).rowsBetween(*_BEFORE))


def _next(fields: list[str]) -> Column:
    return F.last(F.when(F.col("_shown"), F.struct(*fields)), ignorenulls=True).over(_back().rowsBetween(*_BEFORE))


def _prepared(spans: DataFrame, placed: bool = True) -> DataFrame:
    """Texts without nulls; ``placed``: exchanged by form, unless the first window to come does it."""
    text = F.coalesce("clean_text", F.lit(""))
    rows = spans.withColumn("clean_text", text).withColumn("_shown", shown(text))
    return rows.repartition("form_id") if placed else rows


def mark_zones(spans: DataFrame, parts: int | None = None) -> DataFrame:
    """Adds ``zone``: whether a span is before (before), in (zone) or after (rest) the leading bold form of its form's first line.

    The form goes on over bold spans that are no sense number, and over a roman span between two of them if the
    second is a Roman number or the span is a mark that joins words.  It ends with the last span accepted.
    ``parts``: ``spans`` are exchanged by form already.
    """
    rows = _prepared(spans, parts is None).withColumn("_bold", F.col("_shown") & _bold(F.col("style")))
    rows = rows.withColumn("_number", F.col("clean_text").rlike(SENSE)).withColumn("_after", _next(["_bold", "_number", "clean_text"]))
    start = F.min(F.when(F.col("_bold"), F.col("span_ord"))).over(_whole())
    word = strip(F.col("_after.clean_text"))
    joins = strip(F.col("clean_text")).rlike(r"^[./'’\-]+$")
    roman = word.rlike("^[IVXLCDM]+$") & valid_roman(word)
    bridge = (F.col("style") == "roman") & F.col("_after._bold") & ~F.col("_after._number") & (roman | joins)
    accepted = (F.col("_bold") & ~F.col("_number")) | F.coalesce(bridge, F.lit(False))
    rows = rows.withColumn("_start", start)
    wrong = F.col("_shown") & (F.col("span_ord") > F.col("_start")) & ~accepted
    rows = rows.withColumn("_wrong", F.sum(wrong.cast("int")).over(_line().rowsBetween(*_UPTO)))
    inside = F.col("_shown") & (F.col("span_ord") >= F.col("_start")) & (F.col("_wrong") == 0)
    rows = rows.withColumn("_end", F.max(F.when(inside, F.col("span_ord"))).over(_whole()))
    zone = (
        F.when((F.col("line_ord") > 0) | F.col("_start").isNull() | (F.col("span_ord") > F.col("_end")), "rest")
        .when(F.col("span_ord") < F.col("_start"), "before")
        .otherwise("zone")
    )
    return rows.withColumn("zone", zone).select(*spans.columns, "zone")


def header_aliases(marked: DataFrame) -> DataFrame:
    """(form_id, span_ord, alias): bold forms after the leading one, before a sense number and before prose.

    Labels, marks and connectors do not begin prose; any other roman text does.
    """
    rows = _prepared(marked).filter("line_ord = 0 and zone = 'rest'")
    bold = F.col("_shown") & _bold(F.col("style"))
    number = bold & F.col("clean_text").rlike(SENSE)
    prose = F.col("_shown") & (F.col("style") == "roman") & ~header_connector(F.col("clean_text"))
    ended = F.max(number | prose).over(_line().rowsBetween(*_BEFORE))
    # of what follows, the grammar asks only how it begins and whether a slash comes: no span holds the rest of its line
    later = _back().rowsBetween(*_BEFORE)
    begins = F.last(F.when(F.col("clean_text") != "", F.left("clean_text", F.lit(1))), ignorenulls=True).over(later)
    slash = F.max(F.when(F.contains("clean_text", F.lit("/")), "/")).over(later)
    after = F.concat_ws("", begins, slash)
    found = bold & ~number & ~F.coalesce(ended, F.lit(False)) & ~strip(F.col("clean_text")).isin("–", "~")
    rows = rows.withColumn("_found", found).withColumn("_later", after).filter("_found")
    parsed = parse_expression(clean_layout(F.col("clean_text")), F.col("_later"), F.lit(False))
    return rows.select("form_id", "span_ord", clean_layout(parsed["expression"]).alias("alias")).filter("alias <> ''")


def parse_forms(marked: DataFrame, reviewed_variants: DataFrame | None = None) -> DataFrame:
    """One row per form: the parsed header with aliases, and what of it belongs to the content.

    expression, variants, homograph, inline_subentry; opening (marks that shared the headword's span), initial_sense,
    template_operator, pronunciation_prefix; warning.  ``reviewed_variants``: form_id, values (array).
    """
    ordered = lambda where: F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.when(where, F.struct("line_ord", "span_ord", "clean_text")))), lambda x: x["clean_text"]))
    zone = F.col("zone") == "zone"
    heads = _prepared(marked).groupBy("form_id").agg(
        clean_layout(ordered(zone)).alias("zone_text"), ordered(F.col("zone") == "rest").alias("_rest"),
        F.count_if(zone & F.col("_shown") & _bold(F.col("style"))).alias("_chunks"),
    )
    heads = heads.withColumn("p", parse_expression(F.col("zone_text"), F.col("_rest"), F.col("_chunks") > 1))
    aliases = header_aliases(marked).groupBy("form_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("span_ord", "alias"))), lambda x: x["alias"]).alias("_aliases"))
    heads = heads.join(aliases, "form_id", "left")
    none = F.array().cast("array<string>")
    own = F.coalesce("_aliases", none)
    if reviewed_variants is not None:
        heads = heads.join(reviewed_variants.select("form_id", F.col("values").alias("_values")), "form_id", "left")
    more = F.coalesce("_values", none) if reviewed_variants is not None else none
    alias = F.filter(own, lambda a: a != F.col("p.expression"))
    marks = F.col("p.inline_subentry").isNotNull() & ~F.coalesce(F.col("p.inline_subentry"), F.lit("")).rlike(r"[\p{L}\p{N}]")
    return heads.select(
        "form_id", F.col("p.expression").alias("expression"), F.array_distinct(F.concat("p.variants", alias, more)).alias("variants"), F.col("p.homograph").alias("homograph"),
        F.when(~marks, F.col("p.inline_subentry")).alias("inline_subentry"), F.when(marks, F.col("p.inline_subentry")).alias("opening"), F.col("p.initial_sense").alias("initial_sense"),
        F.col("p.template_operator").alias("template_operator"), F.col("p.pronunciation_prefix").alias("pronunciation_prefix"),
        F.when(F.col("_chunks") == 0, "no leading bold expression").when(F.col("p.expression") == "", "expression parsed empty").alias("warning"),
    )


def merge_initials(spans: DataFrame, parts: int | None = None) -> DataFrame:
    """Dotted initials of a line, printed as italic letters and roman periods, become one italic span.

    Two or more initials linked by periods are a chain; it counts if roman text beginning with a period follows its last
    initial, and takes that period with it.  ``parts``: ``spans`` are exchanged by form already.
    """
    rows = _prepared(spans, parts is None)
    style, text = F.col("style"), F.col("clean_text")
    rows = rows.withColumn("_kind", F.when(_italic(style) & strip(text).rlike("^[A-Z]$"), "i").when((style == "roman") & text.rlike(r"(?U)^\s*\.\s*$"), "p").when((style == "roman") & text.rlike(r"(?U)^\s*\."), "s"))
    # neighbours among the spans that are not blank; windows only, so that no join exchanges the spans again
    line = Window.partitionBy("form_id", "line_ord", "_shown").orderBy("span_ord")
    kind = lambda k: F.lead("_kind", k).over(line)
    seen = rows
    seen = seen.withColumn("_link", F.coalesce((F.col("_kind") == "i") & (kind(1) == "p") & (kind(2) == "i"), F.lit(False)))
    seen = seen.withColumn("_linked", F.coalesce(F.lag("_link", 2).over(line), F.lit(False))).withColumn("_then", kind(1)).withColumn("_end", F.lead("span_ord").over(line))
    closes = ~F.col("_link") & F.col("_linked") & F.col("_then").isin("p", "s")
    # chains do not overlap: a span's chain is the last that began, and the chain's end the first last initial from there
    begins = F.when(F.col("_shown") & F.col("_link") & ~F.col("_linked"), F.col("span_ord"))
    ends = F.when(F.col("_shown") & ~F.col("_link") & F.col("_linked"), F.struct(F.when(closes, F.col("_end")).alias("to")))
    seen = seen.withColumn("_last", F.last(ends, ignorenulls=True).over(_back().rowsBetween(*_UPTO)))
    chain = F.last(F.when(begins.isNotNull(), F.struct(F.col("span_ord").alias("a"), F.col("_last.to").alias("b"))), ignorenulls=True).over(_line().rowsBetween(*_UPTO))
    joined = seen.withColumn("_c", chain).withColumn("_in", F.coalesce(F.col("span_ord") <= F.col("_c.b"), F.lit(False)))
    joined = joined.withColumn("_from", F.when(F.col("_in"), F.col("_c.a"))).withColumn("_to", F.when(F.col("_in"), F.col("_c.b")))
    dot = F.regexp_extract("clean_text", r"(?U)^\s*\.", 0)
    piece = lambda at, part, value: F.struct(at.alias("at"), F.lit(part).alias("part"), value.alias("value"))
    tail = F.array(piece(F.col("_from"), 0, dot), piece(F.col("span_ord"), 1, F.substring("clean_text", F.length(dot) + 1, F.length("clean_text"))))
    pieces = F.when(F.col("_to") == F.col("span_ord"), F.filter(tail, lambda p: p["value"] != "")).otherwise(F.array(piece(F.coalesce("_from", "span_ord"), 0, F.col("clean_text"))))
    rest = [c for c in spans.columns if c not in ("form_id", "line_ord", "span_ord", "clean_text")]
    # a chain's pieces meet in a window: an aggregation would sort and copy all other spans as groups of one
    piece = Window.partitionBy("form_id", "line_ord", "_at", "_part").orderBy("span_ord")
    made = joined.select("*", F.explode(pieces).alias("_p")).select("*", F.col("_p.at").alias("_at"), F.col("_p.part").alias("_part"))
    made = made.withColumn("_text", F.array_join(F.collect_list("_p.value").over(piece.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), ""))
    made = made.withColumn("_n", F.row_number().over(piece)).filter("_n = 1")
    text = F.when(F.col("_to").isNotNull() & (F.col("_part") == 0), clean_layout(F.col("_text"))).otherwise(F.col("_text"))
    return made.select("form_id", "line_ord", (F.col("_at") * 2 + F.col("_part")).alias("span_ord"), text.alias("clean_text"), *rest).select(*spans.columns)


def protect_labels(spans: DataFrame) -> DataFrame:
    """Adds ``protected``: an italic span that looks like a label but is the operand of a template or part of a dotted name.

    An operand follows roman text that ends in an operator, on its line or at the end of the line before; a name's part has
    a period before or after it on its line.
    """
    rows = _prepared(spans, placed=False)
    form = Window.partitionBy("form_id").orderBy("line_ord", "span_ord")
    rows = rows.withColumn("_ahead", _previous(["line_ord", "style", "clean_text"], form))
    rows = rows.withColumn("_left", _previous(["style", "clean_text"])).withColumn("_right", _next(["style", "clean_text"]))
    roman = lambda side, pattern: (F.col(f"{side}.style") == "roman") & F.col(f"{side}.clean_text").rlike(pattern)
    near = F.col("_ahead.line_ord") >= F.col("line_ord") - 1
    operand = near & roman("_ahead", r"(?U)[~–]\s*$")
    named = F.coalesce(roman("_left", r"(?U)\.\s*$"), F.lit(False)) | F.coalesce(roman("_right", r"(?U)^\s*\."), F.lit(False))
    return rows.withColumn("protected", F.col("_shown") & _italic(F.col("style")) & (F.coalesce(operand, F.lit(False)) | named)).select(*spans.columns, "protected")


def content_events(spans: DataFrame, known: Column, decisions: DataFrame, joined_lines: DataFrame, forms: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """form_id, ord, kind, style, value, boundary of the content of forms.

    ``spans`` without header zones; ``known``: the labels' codes; ``decisions``: form_id, line_ord (of the line that wraps),
    action; ``joined_lines``: line_id of lines reviewed for missing blanks; ``forms``: headers whose marks, sense, operator
    and opening slash come before the content; ``parts``: ``spans`` are exchanged by form already, into so many partitions.
    """
    if parts is None:
        parts = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spans = spans.repartition(parts, "form_id")
    rows = _prepared(spans, placed=False)
    # rows exchanged alike are put together where they are
    among = lambda these, others: these.unionByName(others.repartition(parts, "form_id"), allowMissingColumns=True)
    # what is known of lines comes as rows among their spans, and windows spread it: a join by line would exchange the spans again
    lines = rows.groupBy("form_id", "line_ord").agg(F.min("line_id").alias("line_id"))
    reviewed = reviewed_lines(lines, joined_lines).select("form_id", "line_ord", F.lit(True).alias("_reviewed"))
    facts = decisions.select("form_id", "line_ord", F.col("action").alias("_action")).unionByName(reviewed, allowMissingColumns=True).withColumn("_fact", F.lit(True))
    rows = among(rows.withColumn("_fact", F.lit(False)), facts).sortWithinPartitions("form_id", "line_ord", "span_ord")
    rows = rows.withColumn("_action", F.max("_action").over(_whole())).withColumn("_reviewed", F.max("_reviewed").over(_whole()))
    # the end of a line decides what its last span and the next line's first event look like
    rows = rows.withColumn("_last", F.max(F.when(F.col("_shown"), F.col("span_ord"))).over(_whole()))
    tight = F.coalesce("join_next", F.lit(False)) | F.coalesce(F.col("_action").isin(*APPLIED), F.lit(False))
    before = Window.partitionBy("form_id").orderBy("line_ord").rangeBetween(-1, -1)
    rows = rows.withColumn("_tight", F.max(F.when(~F.col("_fact"), tight)).over(before)).filter(~F.col("_fact"))
    cut = (F.col("_action") == "remove_hyphen") & (F.col("span_ord") == F.col("_last"))
    rows = rows.withColumn("clean_text", F.when(cut, F.regexp_replace("clean_text", r"(?U)-\s*$", "")).otherwise(F.col("clean_text"))).select(*spans.columns, "_reviewed", "_tight")
    rows = merge_initials(rows, parts)
    rows = protect_labels(rows.withColumn("join_previous", joins_previous(F.col("_reviewed"), _line())))
    style, text = F.col("style"), F.col("clean_text")
    event = lambda kind, value, of=F.lit(None): F.struct(F.lit(kind).alias("kind"), of.cast("string").alias("style"), value.alias("value"))
    codes = F.when(_italic(style) & ~F.col("protected"), tag_codes(text, known)).otherwise(F.array().cast("array<string>"))
    run = F.array(event("run", text, style))
    made = (
        F.when(text == "", F.slice(run, 1, 0))
        .when(~shown(text), run)
        .when(F.size("_codes") > 0, F.transform("_codes", lambda c: event("label", c)))
        .when(_bold(style) & text.rlike(SENSE), F.array(event("sense", strip(text))))
        .when((style == "symbol") & (strip(text) == "→"), F.array(event("arrow", F.lit("→"))))
        .otherwise(run)
    )
    listed = rows.withColumn("_codes", codes).select("form_id", "line_ord", "span_ord", "join_previous", "_tight", F.posexplode(made).alias("k", "e"))
    first = Window.partitionBy("form_id", "line_ord").orderBy("span_ord", "k")
    listed = listed.withColumn("_first", F.row_number().over(first) == 1)
    form = Window.partitionBy("form_id").orderBy("line_ord", "span_ord", "k")
    listed = listed.withColumn("_same", (F.lag("e.kind").over(form) == "run") & (F.col("e.kind") == "run") & (F.lag("e.style").over(form) == F.col("e.style")))
    opening = F.when((F.col("line_ord") == 0) | F.coalesce("_tight", F.lit(False)), "").otherwise(" ")
    joined = F.col("join_previous") & (F.col("k") == 0) & ~F.coalesce("_same", F.lit(False))
    boundary = F.when(joined, JOINED).when(F.col("_first"), opening).otherwise("")
    pieces = listed.select("form_id", (F.col("line_ord") + 1).alias("_a"), F.col("span_ord").cast("long").alias("_b"), "k", "e.kind", "e.style", "e.value", boundary.alias("boundary"))
    if forms is not None:
        empty = F.lit("").alias("boundary")
        heads = F.array(
            F.when(F.col("opening").isNotNull(), event("run", F.col("opening"), F.lit("roman"))), F.when(F.col("initial_sense").isNotNull(), event("sense", F.col("initial_sense").cast("string"))),
            F.when(F.col("template_operator").isNotNull(), event("run", F.col("template_operator"), F.lit("bold"))), F.when(F.col("pronunciation_prefix") != "", event("run", F.col("pronunciation_prefix"), F.lit("roman"))),
        )
        lead = forms.select("form_id", F.posexplode(F.array_compact(heads)).alias("k", "e"))
        pieces = among(pieces, lead.select("form_id", F.lit(0).alias("_a"), F.lit(0).cast("long").alias("_b"), "k", "e.kind", "e.style", "e.value", empty))
    number = F.row_number().over(Window.partitionBy("form_id").orderBy("_a", "_b", "k")).cast("long")
    return pieces.select("form_id", number.alias("ord"), "kind", "style", "value", "boundary")
