"""Normalisation of marker lines: reviewed passes over a whole document, then per form.

Lines: line_no (dense, from 1), marker, value.  All rules come as small tables.  A
sequence of lines can only be rewritten where every line is one that some rule
names, so islands of such lines are collected, wherever form borders lie, and all
others stay rows; an island is as long as the run of named lines.

Applied twice, the passes give what they give once, if no rule's target holds the
source of a rule.  Lines that a header without an expression leaves to the form
before it take part in that form's later passes.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import marker_parts, replace_all, strip
from lexiforge.sources.markers import FORM_KINDS, HEADERS, RUN_TYPES
from lexiforge.sources.scratch import cut

from .ordered import number_rows, running_sum
from .reviewed import _rules, promote_inline_subentries, repair_variants
from .rewrite import sense_boundaries

Sequences = list[tuple[tuple[str, ...], tuple[str, ...]]]
_BEGIN, _END = "\x02", "\x03"
LINE = "struct<marker:string,value:string>"


@dataclass
class Rules:
    """The reviewed tables of one source; empty ones change nothing."""

    sequences: Sequences = field(default_factory=list)  # lines replaced by lines, in table order
    run_values: list[tuple[str, str]] = field(default_factory=list)  # replacements inside runs
    reference_values: list[tuple[str, str]] = field(default_factory=list)  # and inside references
    variant_repairs: DataFrame | None = None  # expression, replaced, replacements
    false_variants: tuple[str, ...] = ()
    inline_subentries: DataFrame | None = None  # root, value
    merged_runs: DataFrame | None = None  # expression, source (array of lines), target
    roman_senses: DataFrame | None = None  # expression, homograph, numbers (array)
    numbered_heads: tuple[tuple[str, int], ...] = ()  # a number after the expression that is no sense


def read_rules(spark: SparkSession, path: str) -> Rules:
    """The reviewed tables of a source from one JSON file: an object with the fields of ``Rules``, tables as lists of rows."""
    found = json.loads("".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))  # reviewed by hand: small
    shapes = {
        "variant_repairs": "expression string, replaced array<string>, replacements array<string>", "inline_subentries": "root string, value string",
        "merged_runs": "expression string, source array<string>, target array<string>", "roman_senses": "expression string, homograph string, numbers array<int>",
    }
    if unknown := sorted(set(found) - {f.name for f in fields(Rules)}):
        raise ValueError(f"{path}: unknown tables {unknown}")
    rules = Rules(**{k: spark.createDataFrame([tuple(r) for r in v], shapes[k]) if k in shapes else v for k, v in found.items()})
    rules.sequences = [(tuple(a), tuple(b)) for a, b in rules.sequences]
    rules.false_variants, rules.numbered_heads = tuple(rules.false_variants), tuple((a, n) for a, n in rules.numbered_heads)
    return rules


def line_text(marker: Column, value: Column) -> Column:
    return F.regexp_replace(F.concat(F.lit("["), marker, F.lit("] "), F.coalesce(value, F.lit(""))), r"(?U)\s+$", "")


def _line(marker: str, value: Column) -> Column:
    return F.struct(F.lit(marker).alias("marker"), value.cast("string").alias("value")).cast(LINE)


def _wrapped(lines: tuple[str, ...]) -> str:
    return "".join(_BEGIN + s + _END for s in lines)


def _renumbered(rows: DataFrame, name: str) -> DataFrame:
    """(line_no, marker, value) of rows in order of (line_no, k)."""
    numbered = number_rows(rows.select(F.col("line_no").alias("line"), F.col("k").alias("place"), "marker", "value"), ["line", "place"], "line_no")
    return cut(numbered.select("line_no", "marker", "value"), name)


def rewrite_sequences(lines: DataFrame, table: Sequences, inside_forms: bool = False) -> DataFrame:
    """Replaces sequences of whole lines, in table order, left to right and without overlap; they may cross forms.

    ``inside_forms``: a sequence does not reach into the next form.
    """
    if not table:
        return lines
    text = line_text(F.col("marker"), F.col("value"))
    names = sorted({s for source, _ in table for s in source})
    rows = lines.withColumn("_t", text).withColumn("_named", F.col("_t").isin(*names))
    named = rows.filter("_named")
    before = named.select((F.col("line_no") + 1).alias("_after"))
    begins = F.col("_after").isNull()
    if inside_forms:
        begins = begins | F.col("marker").isin(*FORM_KINDS)
    islands = running_sum(named.join(before, F.col("line_no") == F.col("_after"), "left").withColumn("_new", begins).drop("_after"), "line_no", F.col("_new"), "island")
    own = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "_t"))), lambda r: F.concat(F.lit(_BEGIN), r["_t"], F.lit(_END)))
    joined = F.array_join(own, "")
    for source, target in table:
        joined = F.replace(joined, F.lit(_wrapped(source)), F.lit(_wrapped(target)))
    out = islands.groupBy("island").agg(F.min("line_no").alias("line_no"), joined.alias("_x")).filter("_x <> ''")
    parts = F.split(F.expr("substring(_x, 2, length(_x) - 2)"), _END + _BEGIN)
    made = out.select("line_no", F.posexplode(parts).alias("k", "_t")).select("line_no", "k", marker_parts(F.col("_t")).alias("m")).select("line_no", "k", "m.marker", "m.value")
    rest = rows.filter("not _named").select("line_no", F.lit(0).alias("k"), "marker", "value")
    return _renumbered(made.unionByName(rest), "sequences")


def with_forms(lines: DataFrame) -> DataFrame:
    return cut(running_sum(lines, "line_no", F.col("marker").isin(*FORM_KINDS), "form_id"), "forms-of-lines")


def repair_heads(lines: DataFrame, numbered_heads: tuple[tuple[str, int], ...] = ()) -> DataFrame:
    """Numbers, marks and equations fused into a form's header become lines after its variants and homograph number.

    A header of nothing but an equation leaves its lines to the form before; without one it raises.
    """
    rows = with_forms(lines)
    w = Window.partitionBy("form_id").orderBy("line_no")
    head = F.col("marker").isin(*FORM_KINDS)
    after = lambda k: line_text(F.lead("marker", k).over(w), F.lead("value", k).over(w))
    rows = rows.withColumn("_head", head).withColumn("_1", after(1)).withColumn("_2", after(2))
    combined, equation = r"(?U)^(.+?)\s+([IVXLCDM]+)(\d+)$", r"(?U)^(.*?)\s*(\d+)\s+(=.+)$"
    part = lambda c, p, k: F.regexp_extract(c, p, k)
    v = F.col("value")
    fused = F.col("_head") & (F.col("marker") == "Entry") & v.rlike(combined)
    rows = rows.withColumn("_fused", fused).withColumn("_e", F.when(fused, part(v, combined, 1)).otherwise(v))
    rows = rows.withColumn("_eq", F.col("_head") & F.col("_e").rlike(equation)).withColumn("_e2", F.when(F.col("_eq"), strip(part(F.col("_e"), equation, 1))).otherwise(F.col("_e")))
    whole = F.lit(False)
    for name, number in numbered_heads:
        whole = whole | ((F.col("_e2") == name) & (F.col("_1") == f"[Sense] {number}") & (F.col("_2") == "[Sense] 1"))
    rows = rows.withColumn("_whole", F.col("_head") & whole).withColumn("_open", F.col("_head") & F.col("_e2").endswith(" ("))
    named = F.when(F.col("_whole"), F.concat_ws(" ", "_e2", F.lead("value").over(w))).when(F.col("_open"), F.regexp_replace("_e2", r"(?U)\s*\($", "")).otherwise(F.col("_e2"))
    none = F.lit(None).cast(LINE)
    extra = F.array_compact(
        F.array(
            F.when(F.col("_fused"), _line("Homograph", part(v, combined, 2))).otherwise(none), F.when(F.col("_fused"), _line("Sense", part(v, combined, 3))).otherwise(none),
            F.when(F.col("_eq"), _line("Sense", part(F.col("_e"), equation, 2))).otherwise(none), F.when(F.col("_eq"), _line("Bold", part(F.col("_e"), equation, 3))).otherwise(none),
            F.when(F.col("_open"), _line("Roman", F.lit("("))).otherwise(none),
        )
    )
    lost = F.col("_eq") & (F.col("_e2") == "")
    lost = F.when(lost & (F.col("form_id") == 1), F.raise_error(F.lit("a numeric header without a form before it")).cast("boolean")).otherwise(lost)
    rows = rows.withColumn("_lost", F.when(F.col("_head"), lost).otherwise(F.lit(False))).withColumn("_name", named).withColumn("_extra", F.when(F.col("_head"), extra))
    rows = rows.withColumn("_gone", F.coalesce(F.lag("_whole").over(w), F.lit(False)))
    # where the header's own lines end
    upto = F.sum((~F.col("marker").isin(*HEADERS)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_body", upto)
    at = F.max(F.when(F.col("_body") == 1, F.col("line_no"))).over(Window.partitionBy("form_id"))
    first = lambda c: F.first(c).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_at", at).withColumn("_all", first("_extra")).withColumn("_cut", first("_lost"))
    keep = F.array(F.struct("marker", F.when(F.col("_head"), F.col("_name")).otherwise(v).alias("value")).cast(LINE))
    nothing = F.array().cast(f"array<{LINE}>")
    place = F.when(F.col("_cut"), F.col("_head")).otherwise(F.col("line_no") == F.col("_at"))
    made = F.concat(F.when(F.col("_gone") | (F.col("_head") & F.col("_lost")), nothing).otherwise(keep), F.when(place, F.col("_all")).otherwise(nothing))
    out = rows.select("line_no", F.posexplode(made).alias("k", "x")).select("line_no", "k", "x.marker", "x.value")
    return _renumbered(out, "heads")


def repair_values(lines: DataFrame, run_values: list[tuple[str, str]], reference_values: list[tuple[str, str]]) -> DataFrame:
    """Reviewed replacements inside runs and references, and two general ones of runs: two dots are one period, no blank before ``)``."""
    runs = F.regexp_replace(F.regexp_replace(replace_all(F.col("value"), run_values), r"(?<!\.)\.\.(?!\.)", "."), r"(?U)\s+\)", ")")
    value = F.when(F.col("marker").isin(*RUN_TYPES), runs).when(F.col("marker").isin("See", "SeeBare"), replace_all(F.col("value"), reference_values)).otherwise(F.col("value"))
    return lines.withColumn("value", value)


def _arrays(rows: DataFrame, table: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Forms that the table names, as (line_no, table's row, lines a), and the lines of all others; of rows with one key the least counts."""
    names = _rules(table.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(F.struct(*[c for c in table.columns if c not in keys])).alias("_r")))
    heads = rows.groupBy("form_id").agg(F.min_by("value", "line_no").alias("expression"), F.min_by(F.when(F.col("marker") == "Homograph", F.col("value")), F.when(F.col("marker") == "Homograph", F.col("line_no"))).alias("homograph"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    hit = cut(heads.join(names, same).select(F.col("form_id").alias("_f"), "_r"), "named-forms")
    inside = rows.join(hit, F.col("form_id") == F.col("_f"))
    arrays = inside.groupBy("form_id").agg(F.min("line_no").alias("line_no"), F.first("_r").alias("r"), F.transform(F.array_sort(F.collect_list(F.struct("line_no", "marker", "value"))), lambda x: F.struct(x["marker"].alias("marker"), x["value"].alias("value")).cast(LINE)).alias("a"))
    return arrays, rows.join(hit, F.col("form_id") == F.col("_f"), "left_anti")


def _back(arrays: DataFrame, rest: DataFrame, name: str) -> DataFrame:
    made = arrays.select("line_no", F.posexplode("a").alias("k", "x")).select("line_no", "k", "x.marker", "x.value")
    return _renumbered(made.unionByName(rest.select("line_no", F.lit(0).alias("k"), "marker", "value")), name)


def merge_runs(lines: DataFrame, table: DataFrame) -> DataFrame:
    """Per form that ``table`` (expression, source, target) names: the first place of the source's lines becomes the target's."""
    arrays, rest = _arrays(with_forms(lines), table, ["expression"])
    wrapped = lambda a: F.array_join(F.transform(a, lambda s: F.concat(F.lit(_BEGIN), s, F.lit(_END))), "")
    text = wrapped(F.transform("a", lambda x: line_text(x["marker"], x["value"])))
    rows = arrays.withColumn("_t", text).withColumn("_s", wrapped(F.col("r.source"))).withColumn("_i", F.expr("instr(_t, _s)"))
    new = F.expr("concat(substring(_t, 1, _i - 1), '')")
    joined = F.when(F.col("_i") > 0, F.concat(new, wrapped(F.col("r.target")), F.expr("substring(_t, _i + length(_s), length(_t))"))).otherwise(F.col("_t"))
    rows = rows.withColumn("_t", joined)
    parts = F.transform(F.split(F.expr("substring(_t, 2, length(_t) - 2)"), _END + _BEGIN), lambda s: marker_parts(s).cast(LINE))
    return _back(rows.withColumn("a", parts), rest, "merged-runs")


def promote_roman_senses(lines: DataFrame, table: DataFrame) -> DataFrame:
    """Senses printed in roman runs, per form that ``table`` (expression, homograph, numbers) names.

    The numbers are looked for one after another, each behind the one before: a sense line is passed; else the first roman
    run that holds the number is cut there.  A fold over the numbers: what lies before the cursor, and what behind it.
    """
    arrays, rest = _arrays(with_forms(lines), table, ["expression", "homograph"])

    def step(s: Column, n: Column) -> Column:
        tail, number = s["tail"], n.cast("string")
        cut_at = F.concat(F.lit(r"(?sU)^(.*?)(?<!\d)"), number, F.lit(r"(?:\s+|$)(.*)$"))
        places = lambda test: F.filter(F.transform(tail, lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())
        sense = F.get(places(lambda x: (x["marker"] == "Sense") & (x["value"] == number)), F.lit(0))
        run = F.get(places(lambda x: (x["marker"] == "Roman") & F.rlike(x["value"], cut_at)), F.lit(0))
        at = F.coalesce(sense, run)
        value = F.get(tail, run)["value"]
        group = lambda k: strip(F.call_function("regexp_extract", value, cut_at, F.lit(k)))
        piece = lambda k: F.when(group(k) != "", _line("Roman", group(k)))
        done = F.when(sense.isNotNull(), F.array(F.get(tail, sense))).otherwise(F.array_compact(F.array(piece(1), _line("Sense", number))))
        left = F.slice(tail, at + 2, F.size(tail))
        more = F.when(sense.isNull(), F.array_compact(F.array(piece(2)))).otherwise(F.array().cast(f"array<{LINE}>"))
        moved = F.struct(F.concat(s["head"], F.slice(tail, F.lit(1), at), done).alias("head"), F.concat(more, left).alias("tail"))
        return F.when(at.isNull(), s).otherwise(moved)

    start = F.struct(F.slice("a", 1, 1).alias("head"), F.slice("a", F.lit(2), F.size("a")).alias("tail"))
    found = F.aggregate("r.numbers", start, step, lambda s: F.concat(s["head"], s["tail"]))
    return _back(arrays.withColumn("a", found), rest, "roman-senses")


def _per_form(lines: DataFrame, change) -> DataFrame:  # noqa: ANN001
    """A rewrite of (form_id, ord, marker, value) applied to (line_no, marker, value)."""
    out = change(with_forms(lines).select("form_id", F.col("line_no").alias("ord"), "marker", "value"))
    return _renumbered(out.select(F.col("form_id").alias("line_no"), F.col("ord").alias("k"), "marker", "value"), "per-form")


def promote_subentries(lines: DataFrame, table: DataFrame) -> DataFrame:
    """``reviewed.promote_inline_subentries`` over whole entries."""
    entries = running_sum(lines, "line_no", F.col("marker") == "Entry", "form_id").select("form_id", F.col("line_no").alias("ord"), "marker", "value")
    out = promote_inline_subentries(entries, table)
    return _renumbered(out.select(F.col("form_id").alias("line_no"), F.col("ord").alias("k"), "marker", "value"), "subentries")


def normalize(lines: DataFrame, rules: Rules | None = None) -> DataFrame:
    """All passes in their order; the result is numbered densely."""
    rules = rules or Rules()
    lines = rewrite_sequences(lines, rules.sequences)
    if rules.inline_subentries is not None:
        lines = promote_subentries(lines, rules.inline_subentries)
    lines = repair_heads(lines, rules.numbered_heads)
    if rules.variant_repairs is not None or rules.false_variants:
        repairs = rules.variant_repairs
        if repairs is None:
            repairs = lines.sparkSession.createDataFrame([], "expression string, replaced array<string>, replacements array<string>")
        lines = _per_form(lines, lambda rows: repair_variants(rows, repairs, rules.false_variants))
    lines = repair_values(lines, rules.run_values, rules.reference_values)
    lines = rewrite_sequences(lines, rules.sequences, inside_forms=True)
    if rules.merged_runs is not None:
        lines = merge_runs(lines, rules.merged_runs)
    if rules.roman_senses is not None:
        lines = promote_roman_senses(lines, rules.roman_senses)
    return _per_form(lines, sense_boundaries)
