"""Queries of the normalisation passes and of nested checks, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.operators import normalize as no
from lexiforge.operators import reviewed, validate
from lexiforge.operators.ordered import number_rows
from lexiforge.plans.registry import query, t
from lexiforge.plans.spans import texts_by
from lexiforge.sources.scratch import cut

_RULES = [(("[Roman] user", "[Roman] assistant"), ("[Roman] pair",)), (("[Roman] pair", "[Entry] c"), ("[Entry] joined", "[Roman] user")), (("[Roman] pair", "[Roman] pair"), ("[Roman] two",))]


def _sql_rules() -> str:
    out = "x"
    for source, target in _RULES:
        wrap = lambda lines: "".join(f"<{s}>" for s in lines)
        out = f"replace({out}, '{wrap(source)}', '{wrap(target)}')"
    return out


@query(f"""WITH l AS (SELECT conv_id, turn, 1 AS k, '[Roman] ' || role AS s FROM conversations UNION ALL SELECT conv_id, min(turn), 0, '[Entry] c' FROM conversations GROUP BY conv_id),
x AS (SELECT string_agg('<' || s || '>', '' ORDER BY conv_id, turn, k) AS x FROM l), y AS (SELECT string_split({_sql_rules()}, '><') AS p FROM x),
z AS (SELECT replace(replace(unnest(p), '<', ''), '>', '') AS s, generate_subscripts(p, 1) AS line_no FROM y)
SELECT CAST(line_no AS BIGINT) AS line_no, regexp_extract(s, '^\\[([^\\]]+)\\]', 1) AS marker, regexp_extract(s, '^\\[[^\\]]+\\] (.*)$', 1) AS value FROM z""")
def sequences_across_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 over the whole document: a rule's lines may belong to two forms."""
    c = t(spark, sf_dir, "conversations")
    rows = c.select("conv_id", "turn", F.lit(1).alias("place"), F.lit("Roman").alias("marker"), F.col("role").alias("value"))
    heads = c.groupBy("conv_id").agg(F.min("turn").alias("turn")).select("conv_id", "turn", F.lit(0).alias("place"), F.lit("Entry").alias("marker"), F.lit("c").alias("value"))
    lines = cut(number_rows(rows.unionAll(heads), ["conv_id", "turn", "place"], "line_no").select("line_no", "marker", "value"), "lines")
    return no.rewrite_sequences(lines, _RULES)


@query("""WITH p AS (SELECT p_partkey AS i, p_partkey % 6 AS k, p_name AS n, p_type AS y, p_brand AS b FROM part),
l AS (SELECT i, CASE k WHEN 0 THEN ['Entry|' || n, 'Variant|v', 'Homograph|XII', 'Sense|3', 'Roman|' || b] WHEN 1 THEN ['Entry|' || n, 'Sense|4', 'Bold|= ' || y, 'Roman|' || b] WHEN 2 THEN ['Sense|4', 'Bold|= ' || y, 'Variant|v', 'Roman|' || b]
  WHEN 3 THEN ['Entry|' || n, 'Roman|(', 'Roman|' || b] WHEN 4 THEN ['Entry|Super 98', 'Sense|1', 'Roman|' || b] ELSE ['Entry|' || n, 'Roman|' || b] END AS a FROM p),
u AS (SELECT i, unnest(a) AS s, generate_subscripts(a, 1) AS j FROM l)
SELECT row_number() OVER (ORDER BY i, j) AS line_no, split_part(s, '|', 1) AS marker, substr(s, strpos(s, '|') + 1) AS value FROM u""")
def normalized_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is fused into headers becomes lines; a header of an equation only leaves its lines to the form before."""
    k = F.col("p_partkey") % 6
    line = lambda marker, value: F.struct(F.lit(marker).alias("marker"), value.cast("string").alias("value"))
    lit = F.lit
    head = (
        F.when(k == 0, line("Entry", F.concat("p_name", lit(" XII3")))).when(k == 1, line("Entry", F.concat("p_name", lit(" 4 = "), "p_type"))).when(k == 2, line("Subentry", F.concat(lit("4 = "), "p_type")))
        .when(k == 3, line("Entry", F.concat("p_name", lit(" (")))).when(k == 4, line("Entry", lit("Super"))).otherwise(line("Entry", F.col("p_name")))
    )
    more = F.when(k.isin(0, 2), F.array(line("Variant", lit("v")))).when(k == 4, F.array(line("Sense", lit("98")), line("Sense", lit("1"))))
    every = F.concat(F.array(head), F.coalesce(more, F.array().cast("array<struct<marker:string,value:string>>")), F.array(line("Roman", F.col("p_brand"))))
    rows = t(spark, sf_dir, "part").select("p_partkey", F.posexplode(every).alias("place", "x")).select("p_partkey", "place", "x.marker", "x.value")
    lines = cut(number_rows(rows, ["p_partkey", "place"], "line_no").select("line_no", "marker", "value"), "lines")
    return no.repair_heads(lines, (("Super", 98),))


# a form per conversation; a run holds two numbers, a sense one; the walk passes senses and cuts runs
@query(r"""WITH RECURSIVE f AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS p, CASE WHEN role = 'assistant' THEN 'Sense' ELSE 'Roman' END AS m,
  CASE WHEN role = 'assistant' THEN CAST(turn + 1 AS VARCHAR) ELSE 'w ' || (turn // 2 + 1) || ' x' || length(text) || ' ' || (turn // 2 + 2) END AS v FROM conversations WHERE conv_id % 3 < 2),
s(conv_id, n, p, rest, q, prefix) AS (SELECT DISTINCT conv_id, 0, CAST(1 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM f
  UNION ALL SELECT conv_id, n + 1, CASE WHEN hs IS NOT NULL THEN hs + 1 WHEN hr IS NULL THEN p WHEN tail = '' THEN hr + 1 ELSE hr END,
    CASE WHEN hs IS NOT NULL THEN NULL WHEN hr IS NULL THEN rest WHEN tail = '' THEN NULL ELSE tail END, CASE WHEN hs IS NULL THEN hr END, CASE WHEN hs IS NULL THEN trim(regexp_extract(x, '^(.*?)(^|[^0-9])' || (n + 1) || '( +|$)', 1) || regexp_extract(x, '^(.*?)(^|[^0-9])' || (n + 1) || '( +|$)', 2)) END
  FROM (SELECT *, trim(regexp_extract(x, '^(.*?)(^|[^0-9])' || (n + 1) || '( +|$)(.*)$', 4)) AS tail FROM (SELECT *, CASE WHEN hr = p AND rest IS NOT NULL THEN rest ELSE (SELECT v FROM f WHERE f.conv_id = h.conv_id AND f.p = hr) END AS x FROM (
    SELECT s.conv_id, n, p, rest, (SELECT min(f.p) FROM f WHERE f.conv_id = s.conv_id AND f.p >= s.p AND f.m = 'Sense' AND f.v = CAST(s.n + 1 AS VARCHAR)) AS hs,
      (SELECT min(f.p) FROM f WHERE f.conv_id = s.conv_id AND f.p >= s.p AND f.m = 'Roman' AND regexp_matches(CASE WHEN f.p = s.p AND s.rest IS NOT NULL THEN s.rest ELSE f.v END, '(^|[^0-9])' || (s.n + 1) || '( +|$)')) AS hr
    FROM s WHERE n < 6) h))),
e AS (SELECT conv_id, n, q, prefix, rest, row_number() OVER (PARTITION BY conv_id, q ORDER BY n) AS j, max(n) OVER (PARTITION BY conv_id, q) = n AS last FROM s WHERE q IS NOT NULL),
o AS (SELECT conv_id, p, 0 AS j, m AS marker, v AS value FROM f WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.conv_id = f.conv_id AND e.q = f.p)
  UNION ALL SELECT conv_id, q, 2 * j, 'Roman', prefix FROM e WHERE prefix <> '' UNION ALL SELECT conv_id, q, 2 * j + 1, 'Sense', CAST(n AS VARCHAR) FROM e UNION ALL SELECT conv_id, q, 1000, 'Roman', rest FROM e WHERE last AND coalesce(rest, '') <> '')
SELECT conv_id, string_agg(marker || ':' || value, '|' ORDER BY p, j) AS lines FROM o GROUP BY conv_id""")
def roman_senses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senses printed in roman runs, searched one after another in the forms that a table names."""
    c = t(spark, sf_dir, "conversations").filter("conv_id % 3 < 2")
    half = F.floor(F.col("turn") / 2)
    run = F.concat_ws(" ", F.lit("w"), half + 1, F.concat(F.lit("x"), F.length("text")), half + 2)
    sense = F.col("role") == "assistant"
    rows = c.select("conv_id", F.col("turn").alias("place"), F.when(sense, "Sense").otherwise("Roman").alias("marker"), F.when(sense, (F.col("turn") + 1).cast("string")).otherwise(run).alias("value"))
    heads = c.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit("Entry").alias("marker"), F.concat(F.lit("e"), "conv_id").alias("value"))
    lines = cut(number_rows(rows.unionAll(heads), ["conv_id", "place"], "line_no").select("line_no", "marker", "value"), "lines")
    table = heads.select(F.col("value").alias("expression"), F.lit(None).cast("string").alias("homograph"), F.sequence(F.lit(1), F.lit(6)).alias("numbers"))
    found = no.with_forms(no.promote_roman_senses(lines, table))
    named = found.groupBy("form_id").agg(F.max(F.when(F.col("marker") == "Entry", F.substring("value", 2, 20).cast("long"))).alias("conv_id"), F.array_sort(F.collect_list(F.when(F.col("marker") != "Entry", F.struct("line_no", F.concat_ws(":", "marker", "value").alias("x"))))).alias("a"))
    return named.select("conv_id", F.array_join(F.transform("a", lambda x: x["x"]), "|").alias("lines"))


@query("""WITH w AS (SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS w FROM documents), r AS (SELECT doc_id, w, list_sum(list_transform(w, lambda x: length(x) + 1)) AS size, doc_id % 2 = 0 AND length(w[1]) > 0 AND length(w[2]) > 2 AS hit FROM w)
SELECT doc_id, len(w) + CASE WHEN hit THEN 1 ELSE 0 END AS n_spans, CASE WHEN hit THEN w[1] || ' ' || left(w[2], 2) ELSE '' END AS bold, CAST(size AS BIGINT) AS n_chars, CASE WHEN hit THEN w[1] ELSE '' END AS variant FROM r""")
def headword_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed headwords, checked against their lines, are cut out of the spans they cross."""
    texts, _ = texts_by(t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("line_id"), "doc_id", "text"), "line_id")
    words = texts.select("line_id", "doc_id", F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ").alias("w"))
    one = words.select("line_id", F.posexplode("w").alias("span_ord", "x")).withColumn("x", F.concat("x", F.lit(" ")))
    spans = one.select("line_id", "span_ord", F.lit("roman").alias("style"), F.col("x").alias("clean_text"), F.col("x").alias("raw_text"), F.lit(0.0).alias("x0"), F.lit(10.0).alias("x1"))
    a, b = F.get("w", F.lit(0)), F.get("w", F.lit(1))
    hit = words.filter((F.col("doc_id") % 2 == 0) & (F.length(a) > 0) & (F.length(b) > 2))
    table = hit.select("line_id", F.concat(a, F.lit(" "), F.left(b, F.lit(2))).alias("headword"), F.array(a).alias("variants"))
    found = reviewed.repair_headwords(spans, table)
    bold = F.transform(F.array_sort(F.collect_list(F.when(F.col("style") == "bold", F.struct("span_ord", "clean_text")))), lambda x: x["clean_text"])
    variant = F.coalesce(F.max(F.get("reviewed_variants", F.lit(0))), F.lit(""))
    return found.groupBy(F.col("line_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n_spans"), F.array_join(bold, "").alias("bold"), F.sum(F.length("clean_text")).cast("long").alias("n_chars"), variant.alias("variant"))


@query("""SELECT doc_id, unnest(CASE doc_id % 7 WHEN 1 THEN ['content/0/content/1/style|unknown style glow'] WHEN 2 THEN ['content/0/content/1|unknown tag b'] WHEN 3 THEN ['content/0/content/1|invalid href x'] WHEN 4 THEN ['content/0/content/1/style|invalid fontStyle bold']
  WHEN 5 THEN ['content/0/content/1|unknown property href', 'content/0/content/1/content/0|a node is text, a list or an object'] WHEN 6 THEN ['content|no JSON'] ELSE [] END) AS found FROM documents""")
def nested_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: trees of text nodes checked level by level; faults lie two and more levels down."""
    k, word = F.col("doc_id") % 7, F.to_json(F.array("text"))
    inner = (
        F.when(k == 1, F.concat(F.lit('{"tag":"span","style":{"glow":"1"},"content":'), word, F.lit("}"))).when(k == 2, F.concat(F.lit('{"tag":"b","content":'), word, F.lit("}")))
        .when(k == 3, F.concat(F.lit('{"tag":"a","href":"x","content":'), word, F.lit("}"))).when(k == 4, F.lit('{"tag":"span","style":{"fontStyle":"bold"}}'))
        .when(k == 5, F.lit('{"tag":"span","href":"?query=x","content":[1]}')).when(k == 6, F.lit("{")).otherwise(F.concat(F.lit('{"tag":"a","href":"?query=x","content":'), word, F.lit("}")))
    )
    tree = F.concat(F.lit('[{"tag":"div","style":{"fontStyle":"italic"},"content":["'), "lang", F.lit('",'), inner, F.lit("]}]"))
    found = validate.invalid_nodes(t(spark, sf_dir, "documents").select("doc_id", tree.alias("tree")), "doc_id", "tree")
    return found.select(F.col("key").alias("doc_id"), F.concat_ws("|", "path", "problem").alias("found"))


_DOTS = r"'(^|[^.])\.\.([^.]|$)', '\1.\2', 'g'"


@query(rf"""WITH d AS (SELECT doc_id AS line_no, CASE doc_id % 3 WHEN 0 THEN 'Roman' WHEN 1 THEN 'See' ELSE 'Label' END AS marker, replace(replace(text, '. ', '.. '), ' ', ' (x ) ') AS x FROM documents)
SELECT line_no, marker, CASE marker WHEN 'Roman' THEN regexp_replace(regexp_replace(replace(regexp_replace(x, '\s+\)', ')', 'g'), 'the', 'THE'), {_DOTS}), {_DOTS}) WHEN 'See' THEN replace(x, 'de', 'D') ELSE x END AS value FROM d""")
def value_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reviewed replacements by the kind of line, and the general ones of runs."""
    k = F.col("doc_id") % 3
    x = F.replace(F.replace("text", F.lit(". "), F.lit(".. ")), F.lit(" "), F.lit(" (x ) "))
    lines = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("line_no"), F.when(k == 0, "Roman").when(k == 1, "See").otherwise("Label").alias("marker"), x.alias("value"))
    return no.repair_values(lines, [("the", "THE")], [("de", "D")])


@query("""WITH l AS (SELECT conv_id, turn + 1 AS place, 'Roman:' || role AS s FROM conversations UNION ALL SELECT DISTINCT conv_id, 0, 'Entry:e' || (conv_id % 3) FROM conversations),
g AS (SELECT conv_id, string_agg('<' || s || '>', '' ORDER BY place) AS x FROM l GROUP BY conv_id),
i AS (SELECT conv_id, x, CASE conv_id % 3 WHEN 0 THEN '<Roman:user><Roman:assistant>' WHEN 1 THEN '<Roman:assistant><Roman:user><Roman:assistant>' END AS s, CASE conv_id % 3 WHEN 0 THEN '<Bold:both>' ELSE '<Bold:a><Bold:b>' END AS r FROM g),
m AS (SELECT conv_id, CASE WHEN s IS NOT NULL AND strpos(x, s) > 0 THEN left(x, strpos(x, s) - 1) || r || substr(x, strpos(x, s) + length(s)) ELSE x END AS x FROM i)
SELECT row_number() OVER (ORDER BY conv_id) AS form_id, replace(substr(x, 2, length(x) - 2), '><', '|') AS lines FROM m""")
def merged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In forms that a table names, the first place of a sequence of lines is replaced."""
    c = t(spark, sf_dir, "conversations")
    rows = c.select("conv_id", (F.col("turn") + 1).alias("place"), F.lit("Roman").alias("marker"), F.col("role").alias("value"))
    heads = c.select("conv_id").distinct().select("conv_id", F.lit(0).cast("long").alias("place"), F.lit("Entry").alias("marker"), F.concat(F.lit("e"), (F.col("conv_id") % 3).cast("string")).alias("value"))
    lines = cut(number_rows(rows.unionAll(heads), ["conv_id", "place"], "line_no").select("line_no", "marker", "value"), "lines")
    rules = [("e0", ["[Roman] user", "[Roman] assistant"], ["[Bold] both"]), ("e1", ["[Roman] assistant", "[Roman] user", "[Roman] assistant"], ["[Bold] a", "[Bold] b"])]
    found = no.with_forms(no.merge_runs(lines, spark.createDataFrame(rules, "expression string, source array<string>, target array<string>")))
    own = F.transform(F.array_sort(F.collect_list(F.struct("line_no", F.concat_ws(":", "marker", "value").alias("x")))), lambda x: x["x"])
    return found.groupBy("form_id").agg(F.array_join(own, "|").alias("lines"))
