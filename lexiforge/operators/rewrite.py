"""Sequence rewrites over the ordered events or lines of a form.

Rewrites that look at fixed neighbours are windows; those that carry a state are
folds (``aggregate``) over a form's sorted array, which is bounded by the form.
Events: form_id, ord, kind, style, value, boundary.  Lines: form_id, ord, marker,
value.  Every function returns its input's columns, with ``ord`` kept ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import LETTER, clean_layout, join_piece
from lexiforge.sources.markers import HEADERS

EVENT = "struct<kind:string,style:string,value:string,boundary:string>"
LINE = "struct<marker:string,value:string>"


def _in_form(order: str = "ord") -> Window:
    return Window.partitionBy("form_id").orderBy(order)


def _fold(df: DataFrame, fields: list[str], body) -> DataFrame:  # noqa: ANN001
    """Apply an array-to-array function per form and number the result anew."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("ord", *fields))), lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    grouped = df.groupBy("form_id").agg(rows.alias("_a")).select("form_id", F.posexplode(body(F.col("_a"))).alias("ord", "_e"))
    return grouped.select("form_id", F.col("ord").cast("long"), *[F.col(f"_e.{f}").alias(f) for f in fields])


def demote_reference_senses(events: DataFrame) -> DataFrame:
    """A number after ``of SMALL CAPS`` and before a period belongs to the reference."""
    w = _in_form()
    run = lambda k, s: (F.lag("kind", k).over(w) == "run") & (F.lag("style", k).over(w) == s)
    period = (F.lead("kind").over(w) == "run") & (F.lead("style").over(w) == "roman") & F.lead("value").over(w).rlike(r"(?U)^\s*\.(?!\.)")
    hit = (F.col("kind") == "sense") & run(1, "small_caps") & run(2, "roman") & F.lag("value", 2).over(w).rlike(r"(?iU)\bof\s*$") & period
    hit = F.coalesce(hit, F.lit(False))
    out = events.withColumn("_hit", hit)
    return out.select(*[F.when(F.col("_hit"), F.lit({"kind": "run", "style": "bold"}[c])).otherwise(F.col(c)).alias(c) if c in ("kind", "style") else F.col(c) for c in events.columns])


def strip_sense_delimiters(events: DataFrame) -> DataFrame:
    """The period that repeats a sense boundary goes; an emptied run goes with it."""
    w = _in_form()
    roman = (F.col("kind") == "run") & (F.col("style") == "roman")
    pattern = r"(?U)^\s*\.(?!\.)(?:\s+|(?=\()|$)"
    # a run that vanishes leaves the sense in place for the next one, so runs of such periods are islands
    gone = F.coalesce(roman & F.col("value").rlike(r"(?U)^\s*\.(?!\.)\s*$"), F.lit(False))
    marked = events.withColumn("_gone", gone)
    keep = F.last(F.when(~F.col("_gone"), F.col("kind")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.coalesce(keep == "sense", F.lit(False))
    marked = marked.withColumn("_after", after)
    value = F.when(F.col("_after") & roman & F.col("value").rlike(pattern), F.regexp_replace("value", pattern + r"\s*", "")).otherwise(F.col("value"))
    kept = marked.withColumn("_v", value).filter(~(F.col("_after") & F.col("_gone")))
    return kept.select(*[F.col("_v").alias("value") if c == "value" else F.col(c) for c in events.columns])


def coalesce_runs(events: DataFrame) -> DataFrame:
    """Join neighbouring runs of one style, piece by piece at their boundaries."""
    w = _in_form()
    new = ~F.coalesce((F.col("kind") == "run") & (F.lag("kind").over(w) == "run") & (F.col("style") == F.lag("style").over(w)), F.lit(False))
    islands = events.withColumn("_new", new.cast("int")).withColumn("_isl", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = F.array_sort(F.collect_list(F.struct("ord", "value", F.coalesce("boundary", F.lit("")).alias("b"))))
    joined = F.aggregate(pieces, F.lit(None).cast("string"), lambda acc, p: F.when(acc.isNull(), p["value"]).otherwise(join_piece(acc, p["value"], p["b"])))
    grouped = islands.groupBy("form_id", "_isl").agg(
        F.min("ord").alias("ord"), F.min_by("kind", "ord").alias("kind"), F.min_by("style", "ord").alias("style"), joined.alias("_v"), F.min_by("boundary", "ord").alias("boundary")
    )
    value = F.when(F.col("kind") == "run", clean_layout(F.col("_v"))).otherwise(F.col("_v"))
    return grouped.withColumn("value", value).filter("kind <> 'run' or value <> ''").select("form_id", "ord", "kind", "style", "value", "boundary")


def split_parenthesized_operators(events: DataFrame) -> DataFrame:
    """``~ (`` before a closed italic phrase: the operator becomes an italic run of its own."""
    w = _in_form()
    is_run = lambda k, s: F.coalesce((F.lead("kind", k).over(w) == "run") & (F.lead("style", k).over(w) == s), F.lit(False))
    ends = r"(?U)([~–])\s*\(\s*$"
    closed = F.lead("value").over(w).contains(")") | (is_run(2, "roman") & F.lead("value", 2).over(w).rlike(r"(?U)^\s*\)"))
    hit = (F.col("kind") == "run") & (F.col("style") == "roman") & F.col("value").rlike(ends) & is_run(1, "italic") & closed
    rows = events.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    prefix = F.regexp_replace(F.regexp_replace("value", ends, ""), r"(?U)\s+$", "")
    b = F.coalesce("boundary", F.lit(""))
    piece = lambda style, value, boundary: F.struct(F.lit(style).alias("style"), value.alias("value"), boundary.alias("boundary"))
    three = F.filter(
        F.array(piece("roman", prefix, b), piece("italic", F.regexp_extract("value", ends, 1), F.when(prefix != "", "").otherwise(b)), piece("roman", F.lit("("), F.lit(""))),
        lambda p: p["value"] != "",
    )
    one = F.array(F.struct(F.col("style"), F.col("value"), b.alias("boundary")))
    out = rows.select("form_id", "ord", "kind", F.posexplode(F.when(F.col("_hit"), three).otherwise(one)).alias("k", "p"))
    return out.select("form_id", (F.col("ord") * 4 + F.col("k")).alias("ord"), "kind", "p.style", "p.value", "p.boundary")


def attach_operators(events: DataFrame) -> DataFrame:
    """Boundary ``~`` and ``–`` of roman runs move into the italic neighbour, left to right.

    A fold: what a run gives to its left neighbour must be seen before the next
    run is looked at.  The accumulator holds the output and what is pending for
    the next italic run.
    """
    ops = r"[~–](?:\s*[~–])*"

    def sign(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit("[~–]"), F.lit(0))
        return F.when(F.size(F.array_distinct(found)) == 1, F.get(found, F.lit(0))).otherwise(F.array_join(found, " "))

    def rewrite(a: Column) -> Column:
        zipped = F.zip_with(a, F.slice(a, F.lit(2), F.size(a)), lambda x, y: F.struct(x.alias("e"), F.coalesce((y["kind"] == "run") & (y["style"] == "italic"), F.lit(False)).alias("next")))
        zipped = F.filter(zipped, lambda z: z["e"].isNotNull())
        event = lambda e, v: F.struct(e["kind"].alias("kind"), e["style"].alias("style"), v.alias("value"), e["boundary"].alias("boundary"))
        start = F.struct(F.array().cast(f"array<{EVENT}>").alias("out"), F.lit("").alias("give"))

        def step(acc: Column, z: Column) -> Column:
            e, out = z["e"], acc["out"]
            run = F.coalesce(e["kind"] == "run", F.lit(False))
            italic, roman = run & (e["style"] == "italic"), run & (e["style"] == "roman")
            last = F.try_element_at(out, F.lit(-1))
            left = F.coalesce((last["kind"] == "run") & (last["style"] == "italic"), F.lit(False))
            v = e["value"]
            # an italic run takes what is pending
            given = F.when((acc["give"] != "") & ~F.regexp_replace(v, r"(?U)^\s+", "").startswith(acc["give"]), clean_layout(F.concat_ws(" ", acc["give"], v))).otherwise(v)
            alone = roman & v.rlike(rf"(?U)^\s*{ops}\s*$")
            right = roman & z["next"] & v.rlike(rf"(?U){ops}\s*$")
            rest = F.when(right, F.regexp_replace(F.regexp_replace(v, rf"(?U){ops}\s*$", ""), r"(?U)\s+$", "")).otherwise(v)
            leads = roman & left & ~(alone & z["next"]) & rest.rlike(rf"(?U)^\s*{ops}")
            lead = sign(F.regexp_extract(rest, rf"(?U)^\s*({ops})", 1))
            own = F.when(leads, F.regexp_replace(rest, rf"(?U)^\s*{ops}\s*", "")).otherwise(rest)
            ended = F.regexp_replace(last["value"], r"(?U)\s+$", "")
            grown = F.when(ended.endswith(lead), last["value"]).otherwise(clean_layout(F.concat_ws(" ", last["value"], lead)))
            base = F.when(leads, F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(event(last, grown)))).otherwise(out)
            mine = F.when(italic, given).when(roman, own).otherwise(v)
            pending = F.when(right, sign(F.regexp_extract(v, rf"(?U)({ops})\s*$", 1))).otherwise(F.lit(""))
            return F.struct(F.concat(base, F.array(event(e, mine))).cast(f"array<{EVENT}>").alias("out"), pending.alias("give"))

        done = F.aggregate(zipped, start, step, lambda acc: acc["out"])
        return F.filter(done, lambda e: (e["kind"] != "run") | (F.regexp_replace(e["value"], r"(?U)\s", "") != ""))

    return _fold(events, ["kind", "style", "value", "boundary"], rewrite)


def arrow_references(events: DataFrame) -> DataFrame:
    """An arrow and the small-caps runs after it become one ``see`` event.

    Small-caps islands directly after an arrow are joined; a bare number with a
    period after it is the target's sense.  If other runs without a sentence end
    stand between, the arrow stays a symbol and the island becomes ``see_bare``.
    """
    w = _in_form()
    blank = (F.col("kind") == "run") & (F.regexp_replace("value", r"(?U)\s", "") == "")
    e = events.filter(~blank)
    caps = F.coalesce((F.col("kind") == "run") & (F.col("style") == "small_caps"), F.lit(False))
    e = e.withColumn("_caps", caps)
    e = e.withColumn("_isl", F.sum((~(F.col("_caps") & F.coalesce(F.lag("_caps").over(w), F.lit(False)))).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sep = F.when(F.col("boundary") != "", F.col("boundary")).otherwise(" ")
    pieces = F.array_sort(F.collect_list(F.struct("ord", clean_layout(F.col("value")).alias("v"), sep.alias("b"))))
    glue = lambda acc, p: F.when(acc.isNull(), p["v"]).when(acc.rlike(r"[-/'’]$"), F.concat(acc, p["v"])).otherwise(join_piece(acc, p["v"], p["b"]))
    joined = F.aggregate(pieces, F.lit(None).cast("string"), glue)
    g = e.groupBy("form_id", "_isl").agg(
        F.min("ord").alias("ord"), F.first("_caps").alias("_caps"), F.min_by("kind", "ord").alias("kind"), F.min_by("style", "ord").alias("style"),
        F.min_by("value", "ord").alias("value"), F.min_by("boundary", "ord").alias("boundary"), joined.alias("target"),
    )
    # what lies between an island and the arrow before it
    stop = (F.col("kind") == "sense") | F.col("_caps") | ((F.col("kind") == "run") & F.col("value").rlike(r"(?U)[.!?](?:\s|$)"))
    mark = F.last(F.when(F.col("kind") == "arrow", F.lit("arrow")).when(stop, F.lit("stop")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    direct = F.lag("kind").over(w) == "arrow"
    g = g.withColumn("_direct", F.coalesce(F.col("_caps") & direct, F.lit(False))).withColumn("_bare", F.coalesce(F.col("_caps") & ~direct & (mark == "arrow"), F.lit(False)))
    ends = F.col("target").rlike(r"(?U)[.;:!?]\s*$")
    period = (F.lead("kind", 2).over(w) == "run") & (F.lead("style", 2).over(w) == "roman") & F.lead("value", 2).over(w).rlike(r"(?U)^\s*[.,;:!?)]")
    suffix = F.coalesce(F.col("_direct") & ~ends & (F.lead("kind").over(w) == "sense") & period, F.lit(False))
    g = g.withColumn("_suffix", suffix).withColumn("_sense", F.lead("value").over(w))
    g = g.withColumn("_taken", F.coalesce(F.lag("_suffix").over(w), F.lit(False))).withColumn("_paired", F.coalesce(F.lead("_direct").over(w), F.lit(False)))
    g = g.withColumn("_ab", F.lag("boundary").over(w))
    g = g.filter(~F.col("_taken") & ~((F.col("kind") == "arrow") & F.col("_paired")))
    tail = F.col("_direct") & F.col("target").rlike(r"(?U)[.;:!?]\s+–$")
    core = F.when(tail, F.regexp_replace("target", r"(?U)\s+–$", "")).otherwise(F.col("target"))
    see = F.when(F.col("_suffix"), F.concat_ws(" ", core, F.col("_sense"))).otherwise(core)
    ev = lambda kind, style, value, boundary: F.struct(kind.alias("kind"), style.alias("style"), value.alias("value"), boundary.alias("boundary")).cast(EVENT)
    none = F.lit(None).cast("string")
    made = (
        F.when(F.col("_direct"), F.array_compact(F.array(ev(F.lit("see"), none, see, F.col("_ab")), F.when(tail, ev(F.lit("run"), F.lit("roman"), F.lit("–"), F.lit(""))))))
        .when(F.col("_bare"), F.array(ev(F.lit("see_bare"), none, F.col("target"), F.col("boundary"))))
        .when(F.col("kind") == "arrow", F.array(ev(F.lit("run"), F.lit("symbol"), F.lit("→"), F.col("boundary"))))
        .when(F.col("_caps"), F.array(ev(F.col("kind"), F.col("style"), F.col("target"), F.col("boundary"))))
        .otherwise(F.array(ev(F.col("kind"), F.col("style"), F.col("value"), F.col("boundary"))))
    )
    out = g.select("form_id", "ord", F.posexplode(made).alias("k", "x"))
    return out.select("form_id", (F.col("ord") * 2 + F.col("k")).alias("ord"), "x.*")


def rewrite_events(events: DataFrame) -> DataFrame:
    """All event passes, in their order."""
    for step in (arrow_references, demote_reference_senses, strip_sense_delimiters, coalesce_runs, split_parenthesized_operators, attach_operators):
        events = step(events)
    return events


def replace_sequences(lines: DataFrame, table: list[tuple[tuple[str, ...], tuple[str, ...]]]) -> DataFrame:
    """Reviewed rewrites of whole line sequences, in table order, left to right.

    ``lines``: form_id, ord, line.  Every line is wrapped in its own start and end
    sign, so neighbouring matches do not share one.
    """
    begin, end = "\x02", "\x03"
    wrap = lambda seq: "".join(begin + s + end for s in seq)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda r: F.concat(F.lit(begin), r["line"], F.lit(end)))
    text = F.array_join(ordered, "")
    for source, target in table:
        text = F.replace(text, F.lit(wrap(source)), F.lit(wrap(target)))
    out = lines.groupBy("form_id").agg(text.alias("t")).filter("t <> ''")
    parts = F.split(F.expr(f"substring(t, 2, length(t) - 2)"), end + begin)  # noqa: F541
    return out.select("form_id", F.posexplode(parts).alias("ord", "line")).withColumn("ord", F.col("ord").cast("long"))


def promote_embedded_senses(lines: DataFrame) -> DataFrame:
    """A number fused into a run becomes a sense if the next sense is its successor."""
    w = _in_form().rowsBetween(1, Window.unboundedFollowing)
    following = F.first(F.when(F.col("marker") == "Sense", F.col("value").cast("int")), ignorenulls=True).over(w)
    rows = lines.withColumn("_next", following)
    bold = F.col("marker").isin("Bold", "BoldItalic")
    back = r"(?sU)^(.+?[\w)])\s+(\d{1,2})$"
    front = r"(?sU)^([^\w]*)(\d{1,2})\s+(.+)$"
    succ = lambda n: F.coalesce(n.try_cast("int") + 1 == F.col("_next"), F.lit(False))
    trailing = bold & F.col("value").rlike(back) & succ(F.regexp_extract("value", back, 2))
    leading = (bold | (F.col("marker") == "Roman")) & F.col("value").rlike(front) & succ(F.regexp_extract("value", front, 2))
    line = lambda m, v: F.struct(m.alias("marker"), v.alias("value"))
    sense = F.lit("Sense")
    number = lambda p: F.regexp_extract("value", p, 2).try_cast("int").cast("string")
    head = F.regexp_extract("value", front, 1)
    three = F.array(line(F.col("marker"), head), line(sense, number(front)), line(F.col("marker"), F.regexp_extract("value", front, 3)))
    new = (
        F.when(trailing, F.array(line(F.col("marker"), F.regexp_extract("value", back, 1)), line(sense, number(back))))
        .when(leading, F.filter(three, lambda x: F.regexp_replace(x["value"], r"(?U)\s", "") != ""))
        .otherwise(F.array(line(F.col("marker"), F.col("value"))))
    )
    out = rows.select("form_id", "ord", F.posexplode(new).alias("k", "x"))
    return out.select("form_id", (F.col("ord") * 4 + F.col("k")).alias("ord"), "x.*")


def sense_boundaries(lines: DataFrame) -> DataFrame:
    """One rising series of senses for each form; what counts inside it is set in bold.

    Numbers fused into runs are freed first.  A form whose first number is above 1
    gets a first sense after its variants and homograph number.  A fold over a form's lines with four fields of state: the last structural
    sense, whether a bold form came since, whether numbering is local, and the
    last local number.
    """

    def rewrite(a: Column) -> Column:
        state = "struct<prev:int,bold:boolean,local:boolean,last:int,out:array<struct<marker:string,value:string>>>"
        start = F.from_json(F.lit('{"bold":false,"local":false,"out":[]}'), state)

        def step(s: Column, x: Column) -> Column:
            sense = x["marker"] == "Sense"
            n = F.when(sense, x["value"].try_cast("int"))
            bold = s["bold"] | (x["marker"].isin("Bold", "BoldItalic") & x["value"].rlike(LETTER))
            resumes = s["local"] & (n == s["prev"] + 1) & (s["last"].isNull() | (n != s["last"] + 1))
            first = s["prev"].isNull()
            restart = ~s["local"] & (n <= s["prev"]) & s["bold"]
            line = lambda m, v: F.array(F.struct(F.lit(m).alias("marker"), v.cast("string").alias("value")))
            nothing = F.array().cast(f"array<{LINE}>")
            as_bold = (s["local"] & ~resumes) | restart | (~s["local"] & (n < s["prev"]))
            kept = F.least(n, s["prev"] + 1)
            add = (
                F.when(~sense, F.array(F.struct(x["marker"].alias("marker"), x["value"].alias("value"))))
                .when(first, line("Sense", n))
                .when(resumes, line("Sense", n))
                .when(as_bold, line("Bold", n))
                .when(n == s["prev"], nothing)
                .otherwise(line("Sense", kept))
            )
            structural = sense & (first | resumes | (~s["local"] & ~restart & (n > s["prev"])))
            return F.struct(
                F.when(structural & (first | resumes), n).when(structural, kept).otherwise(s["prev"]).alias("prev"),
                F.when(~sense, bold).when(structural | restart, F.lit(False)).otherwise(s["bold"]).alias("bold"),
                F.when(~sense, s["local"]).when(resumes, F.lit(False)).when(restart & ~first, F.lit(True)).otherwise(s["local"]).alias("local"),
                F.when(~sense, s["last"]).when(resumes, F.lit(None)).when(~first & (restart | (s["local"] & ~resumes)), n).otherwise(s["last"]).alias("last"),
                F.concat(s["out"], add).alias("out"),
            ).cast(state)

        return F.aggregate(a, start, step, lambda s: s["out"])

    def begun(a: Column) -> Column:
        numbers = F.transform(F.filter(a, lambda x: x["marker"] == "Sense"), lambda x: x["value"].try_cast("int"))
        # the header and the lines that describe it
        body = F.filter(F.transform(a, lambda x, i: F.when((i > 0) & ~x["marker"].isin(*HEADERS), i)), lambda i: i.isNotNull())
        at = F.coalesce(F.get(body, F.lit(0)), F.size(a))
        one = F.array(F.struct(F.lit("Sense").alias("marker"), F.lit("1").alias("value")))
        late = F.coalesce(F.get(numbers, F.lit(0)) > 1, F.lit(False))
        return F.when(late, F.concat(F.slice(a, F.lit(1), at), one, F.slice(a, at + 1, F.size(a)))).otherwise(a)

    return _fold(promote_embedded_senses(lines), ["marker", "value"], lambda a: rewrite(begun(a)))
