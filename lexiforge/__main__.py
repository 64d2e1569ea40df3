"""Command line: ``layer1`` (spans to marker text), ``layer2`` (marker text to archive), ``all``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.functions.text import font_style
from lexiforge.operators import linewrap, normalize, sinks
from lexiforge.plans import layer1 as plan
from lexiforge.plans.build import build
from lexiforge.sources import tables


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexiforge", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("layer1", "layer2", "all"):
        c = sub.add_parser(name)
        c.add_argument("--profile", choices=sorted(tables.PROFILES), default="small")
        c.add_argument("--pages", help="pages such as 21-30,70; default: the profile's")
        c.add_argument("--spans", help="Parquet table of text spans")
        c.add_argument("--source-sha256", help="pin of the span table's files")
        c.add_argument("--input", help="marker text")
        c.add_argument("--tag-map", help="CSV: tag, tag_rename, type, color")
        c.add_argument("--resolutions", help="CSV of reviewed line wraps")
        c.add_argument("--joined-lines", help="CSV with the line_id of lines reviewed for missing blanks")
        c.add_argument("--headwords", help="JSON lines of reviewed headwords: line_id, headword, variants")
        c.add_argument("--rules", help="JSON of the reviewed tables of the normalisation")
        c.add_argument("--intermediate-dir", default="intermediate")
        c.add_argument("--archive-dir", default="archive")
        c.add_argument("--name", default="lexicon")
        c.add_argument("--max-component-bytes", type=int, default=8_000_000)
    return p


def _tags(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.tag_map:
        return tables.read_tag_map(spark, args.tag_map)
    return spark.createDataFrame([], "tag string, tag_rename string, color string")


def layer1(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Spans to marker text, with the lines and line-wrap decisions as JSON evidence and a manifest."""
    paths = tables.profile_paths(args.profile, args.intermediate_dir)
    pages = tables.page_selection(spark, args.pages or tables.PROFILES[args.profile]["pages"], 1 << 20)
    spans = tables.check_source(spark, args.spans, pages, args.source_sha256)
    style = F.coalesce("style", font_style(F.col("font"))) if "style" in spans.columns else font_style(F.col("font"))
    resolutions = tables.read_resolutions(spark, args.resolutions) if args.resolutions else None
    joined = spark.read.csv(args.joined_lines, header=True) if args.joined_lines else None
    heads = spark.read.schema("line_id string, headword string, variants array<string>").json(args.headwords) if args.headwords else None
    rules = normalize.read_rules(spark, args.rules) if args.rules else None
    found = plan.parse_pages(spans.withColumn("style", style), pages, plan.known_codes(_tags(spark, args)), resolutions, joined, heads, rules)
    plan.write_text(spark, found.markers, paths["markers"])
    sinks.write_json(found.lines, paths["debug"])
    sinks.write_json(found.decisions, paths["audit"])
    keys = spark.createDataFrame([], "resolution_key string")
    lost = linewrap.unmatched(resolutions, found.decisions) if resolutions is not None and args.profile == "full" else keys
    wraps = linewrap.audit(found.decisions, lost).first().asDict()
    markers = {r["marker"]: r["count"] for r in found.markers.groupBy("marker").count().collect()}  # one row per marker
    summary = {"lines": found.lines.count(), "forms": found.forms.count(), "entries": markers.get("Entry", 0), "wraps": wraps}
    sinks.write_report({"schema": "typographic-runs", "pages": args.pages or tables.PROFILES[args.profile]["pages"], "markers": markers} | summary, f"{args.intermediate_dir}/{args.profile}/manifest.json", spark)
    return summary


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    """What the command asks for; ``all`` hands the marker text of layer 1 to layer 2."""
    summary: dict = {}
    if args.command in ("layer1", "all"):
        summary["layer1"] = layer1(spark, args)
    if args.command in ("layer2", "all"):
        own = tables.profile_paths(args.profile, args.intermediate_dir)["markers"]
        text = own if args.command == "all" else args.input or own
        summary["layer2"] = build(spark, text, _tags(spark, args), args.archive_dir, args.name, args.max_component_bytes)
    return summary


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("lexiforge").getOrCreate()
    print(json.dumps(run(spark, args), ensure_ascii=False, indent=1))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
