"""Queries of the table-driven operators and of further text functions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.functions import text as tx
from lexiforge.operators import ingest, resolve, reviewed, rewrite, sinks, validate
from lexiforge.plans.registry import _DICT, _dictionary, _refs, query, t
from lexiforge.sources.scratch import cut


@query("""SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN 'small_caps' WHEN 1 THEN 'symbol' WHEN 2 THEN 'bold_italic' WHEN 3 THEN 'bold' WHEN 4 THEN 'italic' WHEN 5 THEN 'small_caps' ELSE 'roman' END AS style FROM part""")
def font_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    fonts = F.lit(["Inresc-Roman", "SymbolMT", "Indrev-BoldItalic", "Indrev-Bold", "Indrev-Italic", "Indrev-Bold-SC700", "Other"])
    return t(spark, sf_dir, "part").select("p_partkey", tx.font_style(F.get(fonts, F.col("p_size") % 7)).alias("style"))


@query("""SELECT p_partkey, p_brand || '|' || p_type || CASE WHEN p_partkey % 2 = 0 THEN '|' || p_name ELSE '' END AS variants FROM part
  UNION ALL SELECT -p_partkey, p_brand || ' / ' || p_name FROM part""")
def variant_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = t(spark, sf_dir, "part"), F.col("p_partkey")
    word = F.when(k % 3 == 0, " and ").when(k % 3 == 1, " OR ").otherwise(" and/or ")
    zone = F.concat("p_brand", word, "p_type", F.when(k % 2 == 0, F.concat(F.lit(" [or "), "p_name", F.lit("]"))).otherwise(""))
    one = p.select("p_partkey", zone.alias("z")).unionAll(p.select(-k, F.concat("p_brand", F.lit(" / "), "p_name")))
    return one.select("p_partkey", F.array_join(tx.split_variants(F.col("z"), F.lit(False)), "|").alias("variants"))


@query("""SELECT p_partkey, 'ber-AB' || p_size || '-' || a || '|' || 'berAB' || p_size || a || '|' || 'berab' || p_size || a AS spellings FROM (SELECT *, lower(split_part(p_type, ' ', 1)) AS a FROM part)""")
def lookup_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.concat(F.lit("ber-AB"), F.col("p_size").cast("string"), F.lit("-"), F.lower(F.split_part("p_type", F.lit(" "), F.lit(1))))
    return t(spark, sf_dir, "part").select("p_partkey", F.array_join(tx.lookup_spellings(source), "|").alias("spellings"))


@query("SELECT p_partkey, lower(p_name) AS target FROM part")
def legacy_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    tail = F.when(k % 3 == 0, " II").when(k % 3 == 1, F.concat(F.lit(" "), F.col("p_size").cast("string"))).otherwise("")
    return t(spark, sf_dir, "part").select("p_partkey", tx.legacy_reference_target(F.concat("p_name", tail)).alias("target"))


@query("""WITH k AS (SELECT p_partkey, lower(split_part(p_name, ' ', 1)) AS a, lower(p_type) AS b, lower(split_part(p_name, ' ', 2)) AS c FROM part)
SELECT p_partkey, unnest([a || b || ' ' || c, a || '- ' || b || c, a || '-' || b || ' ' || c, a || ' ' || b || ' ' || c, a || '--' || b || '-' || c]) AS v FROM k""")
def spacing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda i: F.lower(F.split_part("p_name", F.lit(" "), F.lit(i)))
    key = F.concat(name(1), F.lit("- "), F.lower("p_type"), F.lit(" "), name(2))
    return t(spark, sf_dir, "part").select("p_partkey", F.explode(tx.spacing_variants(key)).alias("v"))


@query("SELECT conv_id, turn, role AS marker, text AS value FROM conversations")
def marker_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("["), "role", F.lit("] "), "text")
    return t(spark, sf_dir, "conversations").select("conv_id", "turn", tx.marker_parts(line).alias("m")).select("conv_id", "turn", "m.marker", "m.value")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN '' ELSE lang || CASE WHEN doc_id % 3 = 1 THEN ',' || lang ELSE '' END END AS codes FROM documents""")
def tag_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    label = F.when(k == 0, F.concat(F.lit(" ("), "lang", F.lit(") "))).when(k == 1, F.concat("lang", F.lit("  "), "lang")).otherwise(F.concat("lang", F.lit(" zz")))
    known = F.lit(["en", "fr", "de", "es"])
    return t(spark, sf_dir, "documents").select("doc_id", F.array_join(reviewed.tag_codes(label, known), ",").alias("codes"))


@query("""SELECT doc_id, doc_id % 6 < 5 AS connects, doc_id % 6 IN (0, 1, 2) AS joins_bold FROM documents""")
def header_connectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = t(spark, sf_dir, "documents"), F.col("doc_id") % 6
    text = F.when(k == 0, " [And/Or] ").when(k == 1, ", or").when(k == 2, ";").when(k == 3, F.concat(F.lit("/"), "lang", F.lit("/"))).when(k == 4, F.concat("lang", F.lit(" [or"))).otherwise(F.concat("lang", F.lit(" band")))
    return d.select("doc_id", reviewed.header_connector(text).alias("connects"), reviewed.joins_bold(text).alias("joins_bold"))


@query("SELECT p_partkey AS entry_id FROM part WHERE p_size % 3 <> 0 AND p_size % 4 <> 0 AND p_partkey % 5 <> 0")
def root_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") % 3 == 0, "orphan_fragment").otherwise("root")
    e = p.select(F.col("p_partkey").alias("entry_id"), kind.alias("entry_type"), (F.col("p_size") % 4).alias("n_forms"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("expression"))
    return reviewed.root_entries(e).select("entry_id")


@query(r"""WITH s AS (SELECT item_id, unnest(regexp_extract_all(text, '\p{L}+|[.,]')) AS s, generate_subscripts(regexp_extract_all(text, '\p{L}+|[.,]'), 1) AS i FROM benchmark),
p AS (SELECT *, lag(s) OVER (PARTITION BY item_id ORDER BY i) AS l FROM s)
SELECT item_id, i AS span_ord FROM p WHERE item_id % 2 = 0 AND i % 3 = 0 AND s NOT IN ('.', ',') AND l NOT IN ('.', ',')""")
def joined_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = t(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"\p{L}+|[.,]"), F.lit(0))).alias("p", "s"))
    i = (F.col("p") + 1).cast("long")
    spans = b.select(F.col("item_id").alias("line_id"), i.alias("span_ord"), F.col("s").alias("clean_text"), (i * 10 + F.when(i % 3 == 0, 0.5).otherwise(2.0)).alias("x0"), (i * 10 + 10).cast("double").alias("x1"))
    lines = t(spark, sf_dir, "benchmark").filter("item_id % 2 = 0").select(F.col("item_id").alias("line_id"))
    return reviewed.mark_joined_spans(spans, lines).filter("join_previous").select(F.col("line_id").alias("item_id"), "span_ord")


@query("""SELECT p_partkey AS form_id, CASE WHEN p_brand = 'Brand#11' THEN 'Entry=' || p_brand || '|Variant=new|Variant=kept|Roman=' || p_name
  WHEN p_brand = 'Brand#12' THEN 'Entry=' || p_brand || '|Variant=old|Variant=kept|Variant=added|Roman=' || p_name
  ELSE 'Entry=' || p_brand || '|Variant=old|Variant=kept|Roman=' || p_name END AS lines FROM part""")
def variant_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = lambda m, v: F.struct(F.lit(m).alias("marker"), v.alias("value"))
    five = F.array(line("Entry", F.col("p_brand")), line("Variant", F.lit("old")), line("Variant", F.lit("kept")), line("Variant", F.lit("false")), line("Roman", F.col("p_name")))
    lines = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("form_id"), F.posexplode(five).alias("ord", "x")).select("form_id", F.col("ord").cast("long"), "x.*")
    table = spark.createDataFrame([("Brand#11", ["old"], ["new", "kept"]), ("Brand#12", ["gone"], ["added"])], "expression string, replaced array<string>, replacements array<string>")
    out = reviewed.repair_variants(lines, table, ("false",)).withColumn("l", F.concat_ws("=", "marker", "value"))
    return out.groupBy("form_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "l"))), lambda x: x["l"]), "|").alias("lines"))


@query("""SELECT p_partkey AS form_id, 'Entry=' || p_brand || CASE WHEN p_brand <> 'Brand#13' THEN '|Bold=inner 2' ELSE '|InlineSubentry=inner|Sense=2' END || '|Roman=inner' AS lines FROM part""")
def inline_subentries(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = lambda m, v: F.struct(F.lit(m).alias("marker"), v.alias("value"))
    three = F.array(line("Entry", F.col("p_brand")), line("Bold", F.lit("inner 2")), line("Roman", F.lit("inner")))
    lines = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("form_id"), F.posexplode(three).alias("ord", "x")).select("form_id", F.col("ord").cast("long"), "x.*")
    table = spark.createDataFrame([("Brand#13", "inner"), ("Brand#99", "inner")], "root string, value string")
    out = reviewed.promote_inline_subentries(lines, table).withColumn("l", F.concat_ws("=", "marker", "value"))
    return out.groupBy("form_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "l"))), lambda x: x["l"]), "|").alias("lines"))


@query("""WITH e AS (SELECT conv_id AS form_id, turn AS ord, turn % 4 AS k FROM conversations),
n AS (SELECT *, lag(k) OVER w AS k1, lag(k, 2) OVER w AS k2, lead(k) OVER w AS f FROM e WINDOW w AS (PARTITION BY form_id ORDER BY ord))
SELECT form_id, CASE WHEN k = 2 AND k1 = 1 AND k2 = 0 AND f = 3 THEN 'run/bold' WHEN k = 2 THEN 'sense/' WHEN k = 1 THEN 'run/small_caps' ELSE 'run/roman' END AS event, count(*) AS n FROM n GROUP BY ALL""")
def reference_senses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    e = t(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("form_id"), F.col("turn").alias("ord"), F.when(k == 2, "sense").otherwise("run").alias("kind"), F.when(k == 1, "small_caps").when(k != 2, "roman").alias("style"),
        F.when(k == 0, "as a form of").when(k == 1, "WORD").when(k == 2, "2").otherwise(". More").alias("value"), F.lit("").alias("boundary"),
    )
    out = rewrite.demote_reference_senses(e).select("form_id", F.concat("kind", F.lit("/"), F.coalesce("style", F.lit(""))).alias("event"))
    return out.groupBy("form_id", "event").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT conv_id, turn, turn % 3 AS k, text FROM conversations), n AS (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM e)
SELECT conv_id AS form_id, turn AS ord, CASE WHEN k = 0 THEN '1' WHEN p = 0 AND k = 1 THEN text ELSE '. ' || text END AS value FROM n""")
def sense_delimiters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 3
    e = t(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("form_id"), F.col("turn").alias("ord"), F.when(k == 0, "sense").otherwise("run").alias("kind"), F.when(k != 0, "roman").alias("style"),
        F.when(k == 0, "1").otherwise(F.concat(F.lit(". "), "text")).alias("value"), F.lit("").alias("boundary"),
    )
    return rewrite.strip_sense_delimiters(e).select("form_id", "ord", "value")


@query("""SELECT doc_id, '["' || replace(e, '"', '\\"') || '","","","",0,[{"tag":"a","href":"?query=' || lang || '&wildcards=off"}],' || doc_id || ',""]' AS row FROM (SELECT doc_id, lang, 'a "' || source || '" é' AS e FROM documents)""")
def term_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _terms(spark, sf_dir).select(F.col("sequence").alias("doc_id"), "row")


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    glossary = F.concat(F.lit('[{"tag":"a","href":"?query='), "lang", F.lit('&wildcards=off"}]'))
    d = t(spark, sf_dir, "documents").select(F.concat(F.lit('a "'), "source", F.lit('" é')).alias("expression"), F.lit("").alias("reading"), glossary.alias("glossary"), F.col("doc_id").alias("sequence"))
    return d.withColumn("row", sinks.term_json(d))


@query("""SELECT lang AS query, count(*) AS n FROM documents WHERE lang <> 'en' GROUP BY 1""")
def json_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of emitted JSON without a destination."""
    links = validate.hrefs(_terms(spark, sf_dir).select("row"), "row", validate.JSON_HREF)
    return validate.dangling(links, spark.createDataFrame([("en",)], "expression string"))


@query("SELECT CAST(p_partkey AS BIGINT) AS id FROM part WHERE p_partkey % 4 = 0 OR p_partkey % 7 = 0")
def invalid_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, e = F.col("p_partkey"), F.lit("")
    rows = t(spark, sf_dir, "part").select(
        F.when(k % 4 != 0, F.col("p_name")).otherwise("").alias("expression"), e.alias("reading"), e.alias("definition_tags"), e.alias("rules"), F.lit(0).alias("score"),
        F.when(k % 7 != 0, '["x"]').otherwise("[]").alias("glossary"), k.alias("sequence"), e.alias("term_tags"),
    )
    return validate.invalid_terms(rows).select(F.col("sequence").alias("id"))


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id % 50, doc_id % 2, round(n_chars % 700 + 0.25, 1), n_chars % 9, doc_id) AS BIGINT) AS pos FROM documents")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexiforge.operators.ordered import number_rows

    d, k = t(spark, sf_dir, "documents"), F.col("doc_id")
    lines = d.select(k.alias("serial"), (k % 50).alias("page"), (k % 2).alias("col"), (F.col("n_chars") % 700 + 0.25).alias("line_y"), (F.col("n_chars") % 9).cast("double").alias("line_x"))
    keyed = lines.select("serial", *[c.alias(f"k{i}") for i, c in enumerate(ingest.reading_order(lines))])
    return number_rows(keyed, [f"k{i}" for i in range(5)], "pos").select(F.col("serial").alias("doc_id"), F.col("pos").cast("long").alias("pos"))


@query(f"""WITH {_DICT}, t AS (SELECT min(q) AS q FROM cand), o AS (SELECT ref_id, 20 AS stage, replace(lower(t.q), 'ß', 'ss') AS key FROM r, t WHERE r.text = (SELECT min(text) FROM r))
SELECT ref_id, CASE WHEN o.ref_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lk WHERE lk.key = replace(lower(strip_accents(r.text)), 'ß', 'ss')) THEN 'reviewed-source-target' ELSE best.method END AS method
FROM r LEFT JOIN best USING (ref_id) LEFT JOIN o USING (ref_id) WHERE coalesce(best.method, CAST(o.stage AS VARCHAR)) IS NOT NULL""")
def reviewed_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = cut(resolve.spellings_index(_dictionary(spark, sf_dir)), "index")
    refs = _refs(spark, sf_dir)
    text, target = refs.agg(F.min("text")).first()[0], index.filter("idx = 'lookup'").agg(F.min("query")).first()[0]
    key = refs.select(tx.fold_key(F.lit(text))).first()[0] if text else ""
    return resolve.resolve(refs, index, {key: target} if key else None).select("ref_id", "method")


_U = "'w' || translate(CAST(p_partkey AS VARCHAR), '0123456789', 'abcdefghij') || 'z'"


@query(f"""SELECT p_partkey AS ref_id, CASE p_partkey % 12 WHEN 0 THEN 'exact' WHEN 1 THEN 'reviewed-source-target' WHEN 2 THEN 'exact' WHEN 3 THEN 'source-notation' WHEN 4 THEN 'optional' WHEN 5 THEN 'optional' WHEN 6 THEN 'spacing'
  WHEN 7 THEN 'embedded-form' WHEN 8 THEN 'unique-prefix' WHEN 9 THEN 'source-phrase' WHEN 10 THEN 'source-phrase-spacing' ELSE 'unresolved' END AS method,
  CASE p_partkey % 12 WHEN 1 THEN 'goal' WHEN 3 THEN u WHEN 4 THEN u || 's' WHEN 5 THEN u || 's' WHEN 6 THEN u || '-kota' WHEN 7 THEN u || ' ' || u || 'an' WHEN 8 THEN u || ' satu dua' WHEN 11 THEN '' ELSE u END AS query FROM (SELECT *, {_U} AS u FROM part)""")
def cascade_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the cascade: every part is an entry and a reference that one stage, and no earlier one, resolves."""
    p = t(spark, sf_dir, "part")
    u = F.concat(F.lit("w"), F.translate(F.col("p_partkey").cast("string"), "0123456789", "abcdefghij"), F.lit("z"))
    rows = p.select(F.col("p_partkey").alias("i"), (F.col("p_partkey") % 12).alias("c"), u.alias("u"))
    plus = lambda text: F.concat("u", F.lit(text))
    pick = lambda cases, other: F.coalesce(*[F.when(F.col("c") == k, v) for k, v in cases.items()], other)
    twin = F.concat("u", F.lit(" "), "u", F.lit("an"))
    entry = pick({3: plus(" (baru)"), 4: plus("s"), 6: plus("-kota"), 7: twin, 8: plus(" satu dua"), 11: plus("-other")}, F.col("u"))
    asked = pick({1: F.lit("Odd name"), 2: F.concat(F.upper("u"), F.lit(" II.")), 3: plus(" (baru)"), 4: plus("(s)"), 5: plus("(s)"), 6: plus(" - kota"), 8: plus(" satu"), 9: plus(" besar"), 10: plus(" bulat - lonjong")}, F.col("u"))
    goal = spark.range(1).select(F.lit(-1).cast("long").alias("sequence"), F.array(F.lit("goal")).alias("spellings"))
    both = rows.filter("c = 5").select((-F.col("i") - 2).alias("sequence"), F.array(plus("s")).alias("spellings"))
    entries = rows.select(F.col("i").cast("long").alias("sequence"), F.array(entry).alias("spellings")).unionAll(both).unionAll(goal)
    item = rows.filter("c in (9, 10)").select(
        F.col("i").cast("long").alias("sequence"), F.col("u").alias("canonical"), F.col("u").alias("expression"), F.col("u").alias("root"), F.lit("italic").alias("type"),
        F.when(F.col("c") == 9, "~ besar").otherwise("– bulat-lonjong").alias("value"), F.lit(None).cast("string").alias("prev_type"), F.lit(None).cast("string").alias("prev_value"),
    )
    index = cut(resolve.spellings_index(entries).unionAll(resolve.content_index(item)), "index")
    refs = rows.select(F.col("i").alias("ref_id"), asked.alias("text"))
    found = resolve.resolve(refs, index, {"odd name": "goal"})
    return refs.join(found.hint("merge"), "ref_id", "left").select("ref_id", F.coalesce("method", F.lit("unresolved")).alias("method"), F.coalesce("query", F.lit("")).alias("query"))
