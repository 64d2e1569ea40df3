"""End to end: marker text to term rows, components and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import clean_text, lookup_candidates
from lexiforge.functions.unicode import nfc
from lexiforge.operators import forms as fo
from lexiforge.operators import groups as gr
from lexiforge.operators import pack, render, resolve, sinks, validate
from lexiforge.sources.markers import marker_errors, read_markers
from lexiforge.sources.scratch import cut


@dataclass
class Lexicon:
    """The tables of one dictionary; what several of them need is written once."""

    forms: DataFrame
    content: DataFrame
    groups: DataFrame
    index: DataFrame
    rendered: DataFrame
    terms: DataFrame


def lexicon(markers: DataFrame, tags: DataFrame, overrides: dict[str, str] | None = None) -> Lexicon:
    """``markers``: line_no, marker, value; ``tags``: tag, tag_rename, color."""
    assigned = cut(fo.assign_forms(markers), "assigned")
    forms, items = fo.forms(assigned), fo.content(assigned)
    full = items.select("form_id").distinct().withColumn("has_content", F.lit(True))
    forms = cut(forms.join(full, "form_id", "left").withColumn("has_content", F.coalesce("has_content", F.lit(False))), "forms")
    items = cut(items, "items")
    groups = cut(gr.row_groups(forms, nfc), "groups")

    own = groups.select("sequence", F.posexplode("form_ids").alias("f", "form_id"), F.col("root_expression").alias("root"))
    spelled = own.join(forms, "form_id").withColumn("_s", F.concat(F.array("expression"), "variants"))
    spellings = spelled.groupBy("sequence").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("f", "_s"))), lambda x: x["_s"])).alias("spellings"))
    spellings = cut(spellings, "spellings")
    canonical = spellings.select("sequence", F.get(lookup_candidates(F.col("spellings")), F.lit(0))["expression"].alias("canonical"))
    w = Window.partitionBy("form_id").orderBy("item_ord")
    near = items.withColumn("prev_type", F.lag("type").over(w)).withColumn("prev_value", F.lag("value").over(w))
    owned = near.join(own.select("form_id", "sequence", "root"), "form_id").join(forms.select("form_id", "expression"), "form_id").join(canonical, "sequence")
    index = cut(resolve.spellings_index(spellings).unionAll(resolve.content_index(owned)), "index")

    # a form is rendered once per group that shows it; each rendering counts
    shown = groups.select("sequence", F.explode("display_ids").alias("form_id"), F.col("root_expression").alias("root"))
    placed = items.join(shown, "form_id").join(forms.select("form_id", "expression"), "form_id")
    placed = placed.withColumn("source_form", F.col("form_id")).withColumn("form_id", F.concat_ws(":", F.col("sequence").cast("string"), F.col("form_id").cast("string")))
    prepared = render.resolve_placeholders(render.collapse_reference_suffixes(render.strip_label_wrappers(placed)))
    prepared = cut(render.sense_segments(prepared), "prepared")
    refs = prepared.filter(F.col("type").isin("see", "see_bare")).withColumn("ref_id", F.concat_ws("@", F.col("form_id"), F.col("item_ord").cast("string")))
    asked = refs.select("ref_id", F.col("value").alias("text"), (F.col("type") == "see").alias("arrow"))
    rendered = cut(resolve.resolve_rendered(asked.select("ref_id", "text"), index, overrides), "rendered")
    nodes = render.reference_nodes(asked, rendered.filter("query is not null")).withColumn("_p", F.split("ref_id", "@"))
    nodes = nodes.select(F.col("_p")[0].alias("form_id"), F.col("_p")[1].cast("long").alias("item_ord"), "node")
    labels = render.split_labels(prepared.filter("type = 'label'"), tags)
    tok = cut(render.tokens(prepared, labels, nodes), "tokens")
    heads = shown.join(forms, "form_id").withColumn("id", F.concat_ws(":", F.col("sequence").cast("string"), F.col("form_id").cast("string")))
    form_lines = render.lines(tok, heads.select(F.col("id").alias("form_id"), "expression", "homograph"))
    kinds = heads.select(F.col("id").alias("form_id"), "kind")
    display = groups.select("sequence", F.transform("display_ids", lambda f: F.concat_ws(":", F.col("sequence").cast("string"), f.cast("string"))).alias("display_ids"))

    named = [groups.select("sequence", F.lit(r).alias("rel"), F.posexplode(col).alias("pos", "name")) for r, (_, col) in enumerate(render.RELATIONS)]
    related = named[0].unionAll(named[1]).unionAll(named[2]).withColumn("ref_id", F.concat_ws("@", F.col("sequence").cast("string"), F.col("rel").cast("string"), F.col("pos").cast("string")))
    solved = resolve.resolve(related.select("ref_id", F.col("name").alias("text")), index, overrides).select("ref_id", "query")
    related = related.join(solved, "ref_id", "left")
    node = F.when(F.col("query").isNotNull(), render.link_node(F.col("query"), F.col("name"))).otherwise(render._quoted(F.col("name")))
    glossary = render.glossaries(display, form_lines, kinds, related.select("sequence", "rel", "pos", node.alias("node")))

    pairs = spellings.select("sequence", F.posexplode(lookup_candidates(F.col("spellings"))).alias("alias", "p"))
    terms = pairs.join(glossary, "sequence").select(
        "sequence", "alias", F.col("p.expression").alias("expression"), F.col("p.reading").alias("reading"), "glossary"
    )
    return Lexicon(forms, items, groups, index, rendered, terms)


def build(spark: SparkSession, markers_path: str, tags: DataFrame, out: str, name: str = "lexicon", limit: int = pack.DEFAULT_LIMIT) -> dict:
    """Marker text to an archive; returns the summary and raises on any violation."""
    markers = read_markers(spark, markers_path).persist()
    if bad := marker_errors(markers).orderBy("line_no").take(1):
        raise ValueError(f"{markers_path}:{bad[0]['line_no']}: {bad[0]['problem']}")
    lex = lexicon(markers, tags)
    terms = lex.terms.withColumn("payload", sinks.term_json(lex.terms)).withColumn("bytes", F.octet_length("payload"))
    # sequence and alias are dense and small: one ordering column
    terms = terms.withColumn("ord", F.col("sequence") * (1 << 20) + F.col("alias")).persist()
    blank = F.lit("")
    rows = terms.select("expression", "reading", blank.alias("definition_tags"), blank.alias("rules"), F.lit(0).alias("score"), "glossary", "sequence", blank.alias("term_tags"))
    if wrong := validate.invalid_terms(rows).take(1):
        raise ValueError(f"invalid term row {wrong[0]['sequence']}: {wrong[0]['expression']!r}")
    once = terms.groupBy("sequence").agg(F.first("glossary").alias("glossary"))  # aliases share it
    if wrong := validate.invalid_nodes(once, "sequence", "glossary", "$[0].content").take(1):
        raise ValueError(f"invalid node in term row {wrong[0]['key']}, {wrong[0]['path']}: {wrong[0]['problem']}")
    packed = pack.pack(terms, "ord", "bytes", limit).persist()
    sizes = pack.bank_sizes(packed, "bytes")
    if validate.oversized(sizes, limit).take(1):
        raise ValueError("a component exceeds the limit")
    links = validate.hrefs(terms.select("glossary"), "glossary", validate.JSON_HREF)
    if lost := validate.dangling(links, terms).take(20):
        raise ValueError("links without destination: " + ", ".join(r["query"] for r in lost))
    members = sinks.write_archive(sinks.banks(packed, "ord", "payload"), {"title": name, "format": 3, "revision": "1"}, f"{out}/{name}.zip")
    written = sinks.check_archive(f"{out}/{name}.zip", limit)
    if written != (n_terms := terms.count()):
        raise ValueError(f"{written} rows were written of {n_terms}")
    found = resolve.report(lex.rendered)
    counts = found.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("names")).collect()
    summary = {"terms": n_terms, "groups": lex.groups.count(), "members": members} | {r["kind"]: r["n"] for r in counts}
    methods = {r["name"]: r["n"] for r in found.filter("kind = 'resolved'").collect()}  # one row per method
    targets = {r["kind"]: r["names"] for r in counts}.get("unresolved", 0)
    sinks.write_report(summary | {"methods": methods, "unresolved_targets": targets}, f"{out}/{name}-report.json", spark)
    sinks.write_json(resolve.unresolved_targets(lost_references(lex)), f"{out}/{name}-unresolved")
    return summary


def lost_references(lex: Lexicon) -> DataFrame:
    """(ord, target, example) of references that nothing resolves; the example is the form's expression, ``ord`` the place of the rendering."""
    shown = F.split(F.split("ref_id", "@")[0], ":")
    rows = lex.rendered.filter("method is null").select(
        (shown[0].cast("long") * (1 << 20) + F.split("ref_id", "@")[1].cast("long")).alias("ord"), shown[1].cast("long").alias("_form"), clean_text(F.col("text")).alias("target")
    )
    names = lex.forms.select(F.col("form_id").alias("_f"), F.col("expression").alias("example"))
    return rows.join(names, F.col("_form") == F.col("_f"), "left").select("ord", "target", "example")
