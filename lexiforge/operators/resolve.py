"""The resolution cascade: ranked equi-joins of references against lookup indexes.

All stages are computed by one long join of (ref_id, stage, key) with a table of
(index, key, query); the first stage whose queries are unique wins.  Nothing is
collected and no index is a map: every index is rows.  The joins are hinted to
shuffle: requests are many small rows from few columns, so their size is estimated
too low, and what was broadcast by it would pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import LETTER, casefold_latin, clean_text, expand_optional, fold_key, let, lookup_candidates, reference_base, spacing_variants

KeyOf = Callable[[Column], Column]
#: Stage, index it asks, and the method it reports; earlier stages win.
STAGES = (
    (10, "lookup", "exact"),
    (20, "lookup", "reviewed-source-target"),
    (30, "lookup", "exact"),
    (40, "notation", "source-notation"),
    (50, "lookup", "optional"),
    (60, "lookup", "optional"),  # 60..92: single expansions, the fullest first
    (100, "lookup", "spacing"),
    (110, "embedded", "embedded-form"),
    (120, "prefix", "unique-prefix"),
    (130, "phrase", "source-phrase"),
    (140, "phrase", "source-phrase-spacing"),
)


def spellings_index(groups: DataFrame, key: KeyOf = fold_key, prefixes: bool = True) -> DataFrame:
    """(idx, key, query) and lookup destinations from (sequence, spellings array)."""
    cands = groups.select("sequence", "spellings", lookup_candidates(F.col("spellings")).alias("c")).filter(F.size("c") > 0)
    cands = cands.withColumn("canonical", F.get("c", F.lit(0))["expression"])
    lookup = cands.select("sequence", F.explode("c").alias("p")).select(F.lit("lookup").alias("idx"), casefold_latin(F.col("p.expression")).alias("key"), F.col("p.expression").alias("query"), "sequence")
    source = cands.select("sequence", "canonical", F.explode(F.array_distinct("spellings")).alias("s")).withColumn("k", key(F.col("s")))
    source = source.withColumn("w", F.split("k", " "))
    row = lambda df, idx, col: df.select(F.lit(idx).alias("idx"), col.alias("key"), F.col("canonical").alias("query"), "sequence")
    out = lookup.unionAll(row(source, "notation", F.col("k")))
    if prefixes:
        heads = source.filter(F.size("w") > 1).withColumn("h", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda n: F.array_join(F.slice("w", F.lit(1), n), " "))))
        out = out.unionAll(row(heads, "prefix", F.col("h")))
        a, b = F.get("w", F.lit(0)), F.get("w", F.lit(1))
        twin = source.filter((F.size("w") == 2) & (F.length(a) >= 3) & (F.length(b) >= 3) & (a.contains(b) | b.contains(a)))
        out = out.unionAll(row(twin.withColumn("h", F.explode("w")), "embedded", F.col("h")))
    return out


def content_index(items: DataFrame, key: KeyOf = fold_key) -> DataFrame:
    """Embedded forms and template phrases: (sequence, canonical, expression, root, type, value, prev_type, prev_value)."""
    bold = items.filter(F.col("type").isin("bold", "bold_italic")).withColumn("b", reference_base(F.col("value"))).filter(F.col("b").rlike(LETTER))
    bold = bold.withColumn("s", F.explode(expand_optional(F.col("b")))).select(F.lit("embedded").alias("idx"), key(F.col("s")).alias("key"), F.col("canonical").alias("query"), "sequence")
    runs = ("roman", "italic", "bold", "bold_italic", "small_caps", "symbol")
    v = clean_text(F.col("value"))
    after_dash = F.coalesce(F.col("prev_type").isin(*runs) & F.col("prev_value").rlike(r"(?U)(?<!\w)–\s*$"), F.lit(False))
    phrases = F.array(
        F.when(v.startswith("~"), clean_text(F.concat_ws(" ", "expression", F.regexp_replace(v, "^~", "")))),
        F.when(v.startswith("–"), clean_text(F.concat_ws(" ", "root", F.regexp_replace(v, "^–", "")))),
        F.when(after_dash & (v != ""), clean_text(F.concat_ws(" ", F.col("root"), v))),
    )
    phrase = items.filter(F.col("type").isin("italic", "bold_italic")).withColumn("p", F.explode(F.array_compact(phrases))).filter("p <> ''")
    return bold.unionAll(phrase.select(F.lit("phrase").alias("idx"), key(F.col("p")).alias("key"), F.col("canonical").alias("query"), "sequence"))


def requests(refs: DataFrame, overrides: dict[str, str] | None = None, key: KeyOf = fold_key) -> DataFrame:
    """(ref_id, stage, idx, key) for (ref_id, text)."""
    seen = refs.select("ref_id", clean_text(F.col("text")).alias("visible"), reference_base(F.col("text")).alias("base"))
    seen = seen.select("ref_id", key(F.col("visible")).alias("k0"), "base", key(F.col("base")).alias("k"))
    ask = lambda stage, idx, k: F.struct(F.lit(stage).alias("stage"), F.lit(idx).alias("idx"), k.alias("key"))
    first = [ask(10, "lookup", F.col("k0"))]
    if overrides:
        table = F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv])
        first.append(ask(20, "lookup", casefold_latin(F.try_element_at(table, F.col("k0")))))
    rest = [ask(30, "lookup", F.col("k")), ask(40, "notation", F.col("k")), ask(110, "embedded", F.col("k")), ask(120, "prefix", F.col("k")), ask(130, "phrase", F.col("k"))]

    def expanded(e: Column) -> Column:
        union = F.transform(e, lambda s: ask(50, "lookup", key(s)))
        alone = F.transform(F.reverse(e), lambda s, i: F.struct((F.lit(60) + i).alias("stage"), F.lit("lookup").alias("idx"), key(s).alias("key")))
        return F.concat(union, alone)

    spaced = let(spacing_variants(F.col("k")), lambda v: F.concat(F.transform(v, lambda s: ask(100, "lookup", s)), F.transform(v, lambda s: ask(140, "phrase", s))))
    later = F.when(F.col("base") != "", F.concat(F.array(*rest), let(expand_optional(F.col("base")), expanded), spaced)).otherwise(F.array().cast("array<struct<stage:int,idx:string,key:string>>"))
    return seen.select("ref_id", F.explode(F.concat(F.array(*first), later)).alias("a")).select("ref_id", "a.*").filter("key is not null")


def resolve(refs: DataFrame, index: DataFrame, overrides: dict[str, str] | None = None, key: KeyOf = fold_key) -> DataFrame:
    """(ref_id, method, query) of every reference that resolves.

    Queries of a stage are unique if they fold to one, or if all have the same
    destinations; the shortest, then the first, is taken.
    """
    index = index.select("idx", "key", "query", "sequence")
    goals = index.filter("idx = 'lookup'").groupBy("key").agg(F.sort_array(F.collect_set("sequence")).alias("goal"))
    entries = index.select("idx", "key", "query").distinct().withColumn("_fq", casefold_latin(F.col("query")))
    entries = entries.join(goals.withColumnRenamed("key", "_fq").hint("merge"), "_fq", "left")
    met = requests(refs, overrides, key).distinct().join(entries.hint("merge"), ["idx", "key"])
    stages = met.groupBy("ref_id", "stage").agg(
        F.countDistinct("_fq").alias("n"),
        F.countDistinct(F.coalesce(F.array_join(F.transform("goal", lambda g: g.cast("string")), ","), F.lit(""))).alias("goals"),
        F.min(F.struct(F.length("query").alias("len"), F.col("query").alias("q"))).alias("q"),
    )
    unique = stages.filter("n = 1 or goals = 1")
    best = unique.groupBy("ref_id").agg(F.min(F.struct("stage", F.col("q.q").alias("query"))).alias("b"))
    method = F.lit(None).cast("string")
    for stage, _, name in STAGES:
        method = F.when(F.col("b.stage") >= stage, name).otherwise(method)
    return best.select("ref_id", method.alias("method"), F.col("b.query").alias("query"))


def segments(refs: DataFrame, resolved_parts: DataFrame | None = None) -> DataFrame:
    """Targets of (ref_id, text): split at ``,`` and ``;`` and, for references in
    ``resolved_parts`` (ref_id), at ``/``; (ref_id, seg, text, is_target)."""
    slashed = refs
    if resolved_parts is not None:
        slashed = refs.join(resolved_parts.select("ref_id", F.lit(True).alias("_slash")), "ref_id", "left")
        cut = F.when(F.coalesce("_slash", F.lit(False)), F.split("text", r"(?U)[,;/]\s*")).otherwise(F.split("text", r"(?U)[,;]\s*"))
    else:
        cut = F.split("text", r"(?U)[,;]\s*")
    parts = slashed.select("ref_id", F.posexplode(cut).alias("seg", "text")).filter("text <> ''")
    number = F.col("text").rlike(r"(?iU)^\s*(?:[IVXLCDM]+(?:\s+\d+)?|\d+)\.?\s*$")
    return parts.withColumn("is_target", ~number)


def slash_parts(refs: DataFrame) -> DataFrame:
    """(ref_id, part, text) of references with several parts around slashes."""
    parts = refs.withColumn("_p", F.filter(F.split("text", r"(?U)/\s*"), lambda p: p != "")).filter(F.size("_p") > 1)
    return parts.select("ref_id", F.posexplode("_p").alias("part", "text"))


def resolve_rendered(refs: DataFrame, index: DataFrame, overrides: dict[str, str] | None = None, key: KeyOf = fold_key) -> DataFrame:
    """(ref_id, seg, text, method, query) of all target segments; method null if unresolved."""
    parts = slash_parts(refs).withColumn("pid", F.concat_ws("#", F.col("ref_id").cast("string"), F.col("part").cast("string")))
    found = resolve(parts.select(F.col("pid").alias("ref_id"), "text"), index, overrides, key).select(F.col("ref_id").alias("pid"), F.lit(True).alias("ok"))
    whole = parts.join(found, "pid", "left").groupBy("ref_id").agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("all")).filter("all")
    segs = segments(refs, whole).filter("is_target").withColumn("sid", F.concat_ws("#", F.col("ref_id").cast("string"), F.col("seg").cast("string")))
    solved = resolve(segs.select(F.col("sid").alias("ref_id"), "text"), index, overrides, key).withColumnRenamed("ref_id", "sid")
    return segs.join(solved.hint("merge"), "sid", "left").select("ref_id", "seg", "text", "method", "query")


def report(rendered: DataFrame) -> DataFrame:
    """(kind, name, n): resolved by method, unresolved by target."""
    done = rendered.filter("method is not null").groupBy(F.lit("resolved").alias("kind"), F.col("method").alias("name")).agg(F.count("*").alias("n"))
    lost = rendered.filter("method is null").groupBy(F.lit("unresolved").alias("kind"), clean_text(F.col("text")).alias("name")).agg(F.count("*").alias("n"))
    return done.unionAll(lost)


def unresolved_targets(lost: DataFrame, n_examples: int = 5) -> DataFrame:
    """(target, n, examples) of unresolved (ord, target, example): most first, then by folded name, then first seen.

    Examples are a target's first distinct ones; a null one is counted but not shown,
    and a null target is a target.
    """
    pairs = lost.groupBy("target", "example").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
    totals = pairs.groupBy("target").agg(F.sum("n").alias("n"), F.min("ord").alias("ord"))
    place = F.row_number().over(Window.partitionBy("target").orderBy("ord", "example"))
    top = pairs.filter("example is not null").withColumn("_k", place).filter(F.col("_k") <= n_examples)
    shown = top.groupBy(F.col("target").alias("_t")).agg(F.sort_array(F.collect_list(F.struct("_k", "example"))).alias("_x"))
    rows = totals.join(shown, F.col("target").eqNullSafe(F.col("_t")), "left")
    examples = F.coalesce(F.col("_x.example"), F.array().cast("array<string>"))
    return rows.orderBy(F.desc("n"), casefold_latin(F.col("target")), "ord").select("target", "n", examples.alias("examples"))
