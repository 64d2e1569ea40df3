"""Queries of segmentation, of item rewrites and of reference parts, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.functions.unicode import nfc
from lexiforge.operators import groups, ingest, render, resolve, rewrite
from lexiforge.operators.ordered import number_rows
from lexiforge.plans.registry import query, t
from lexiforge.sources.scratch import cut


@query("""WITH p AS (SELECT doc_id AS page, doc_id - row_number() OVER (ORDER BY doc_id) AS run FROM documents WHERE doc_id % 10 < 8),
l AS (SELECT doc_id AS page, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_ord FROM documents),
b AS (SELECT page, line_ord, run, length(s) % 7 = 0 AS root, length(s) % 7 = 1 AS sub, row_number() OVER (ORDER BY page, line_ord) AS n FROM l JOIN p USING (page) WHERE length(s) % 7 <> 2),
g AS (SELECT *, coalesce(lag(run) OVER (ORDER BY n) <> run, true) AS gap FROM b),
e AS (SELECT *, sum(CASE WHEN root OR gap THEN 1 ELSE 0 END) OVER (ORDER BY n) AS entry_id, sum(CASE WHEN root OR gap OR sub THEN 1 ELSE 0 END) OVER (ORDER BY n) AS form_id FROM g),
k AS (SELECT entry_id, arg_min(root, n) AS is_root, arg_min(form_id, n) AS f, max(n) AS last FROM e GROUP BY entry_id),
c AS (SELECT n - 1 AS last, root AND NOT gap AS closed FROM g WHERE root OR gap)
SELECT page, CAST(line_ord AS BIGINT) AS line_ord, CAST(entry_id AS BIGINT) AS entry_id, CAST(form_id AS BIGINT) AS form_id, CASE WHEN is_root THEN 'root' ELSE 'orphan_fragment' END AS entry_type,
  CASE WHEN form_id <> f THEN 'subentry' WHEN is_root THEN 'root' ELSE 'orphan' END AS form_type, NOT is_root AS partial_start, NOT coalesce(closed, false) AS partial_end FROM e JOIN k USING (entry_id) LEFT JOIN c USING (last)""")
def entry_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries and forms over lines and pages; every document is a page, and some pages are not selected."""
    d = t(spark, sf_dir, "documents")
    k = F.length("s") % 7
    kind = F.when(k == 0, "root_entry_start").when(k == 1, "subentry_start").when(k == 2, "running_header").otherwise("continuation")
    lines = d.select(F.col("doc_id").alias("page"), F.posexplode(F.split("text", "\n")).alias("line_ord", "s")).select("page", F.col("line_ord").cast("long").alias("line_ord"), kind.alias("line_class"))
    pages = d.select(F.col("doc_id").alias("page")).filter("page % 10 < 8")
    placed = cut(number_rows(lines, ["page", "line_ord"], "pos"), "placed")
    return ingest.segment(placed, pages).select("page", "line_ord", "entry_id", "form_id", "entry_type", "form_type", "partial_start", "partial_end")


_ITEMS = """w AS (SELECT doc_id AS form_id, lang, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w, generate_subscripts(string_split(replace(text, chr(10), ' '), ' '), 1) - 1 AS i FROM documents),
h AS (SELECT *, (length(w) * 3 + i) % 6 AS h FROM w)"""


def _items(spark: SparkSession, sf_dir: str, kind: Column, value: Column) -> DataFrame:
    words = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("form_id"), "lang", F.posexplode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("i", "w"))
    words = words.withColumn("h", (F.length("w") * 3 + F.col("i")) % 6)
    return words.select("form_id", F.col("i").cast("long").alias("item_ord"), kind.alias("type"), value.alias("value"))


def _digest(items: DataFrame) -> DataFrame:
    own = F.transform(F.array_sort(F.collect_list(F.struct("item_ord", F.concat_ws(":", "type", "value").alias("x")))), lambda s: s["x"])
    return items.groupBy("form_id").agg(F.count("*").alias("n_items"), F.sum(F.length("value")).cast("long").alias("n_chars"), F.sha2(F.array_join(own, "\n"), 256).alias("digest"))


_SUM = "count(*) AS n_items, CAST(sum(length(v)) AS BIGINT) AS n_chars, sha256(string_agg(k || ':' || v, chr(10) ORDER BY i)) AS digest"


@query(rf"""WITH {_ITEMS},
s AS (SELECT form_id, i, CASE WHEN h IN (0, 1) THEN 'label' ELSE 'roman' END AS k, CASE h WHEN 0 THEN lang WHEN 1 THEN lang WHEN 2 THEN w || ' (' WHEN 3 THEN ') ' || w WHEN 4 THEN '] ' || w || ' (' ELSE ')' || w || '[' END AS v FROM h),
r AS (SELECT *, sum(CASE WHEN k = 'label' THEN 0 ELSE 1 END) OVER (PARTITION BY form_id ORDER BY i) AS g, lead(k) OVER w AS nk, lag(k) OVER w AS pk FROM s WINDOW w AS (PARTITION BY form_id ORDER BY i)),
n AS (SELECT a.*, p.v AS pv, q.v AS nv FROM r a LEFT JOIN r p ON p.form_id = a.form_id AND p.g = a.g - 1 AND p.k = 'roman' AND a.k = 'roman' LEFT JOIN r q ON q.form_id = a.form_id AND q.g = a.g + 1 AND q.k = 'roman' AND a.k = 'roman'),
m AS (SELECT *, k = 'roman' AND nk = 'label' AND regexp_extract(v, '([\[(])\s*$', 1) || regexp_extract(nv, '^\s*([\])])', 1) IN ('()', '[]') AS o, k = 'roman' AND pk = 'label' AND regexp_extract(pv, '([\[(])\s*$', 1) || regexp_extract(v, '^\s*([\])])', 1) IN ('()', '[]') AS c FROM n),
z AS (SELECT form_id, i, k, CASE WHEN coalesce(o, false) THEN regexp_replace(x, '\s*[\[(]\s*$', '') ELSE x END AS v FROM (SELECT *, CASE WHEN coalesce(c, false) THEN regexp_replace(v, '^\s*[\])]\s*', '') ELSE v END AS x FROM m))
SELECT form_id, {_SUM} FROM z GROUP BY form_id""")
def label_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brackets that enclose labels only and match go."""
    h = F.col("h")
    value = (
        F.when(h < 2, F.col("lang")).when(h == 2, F.concat("w", F.lit(" ("))).when(h == 3, F.concat(F.lit(") "), "w")).when(h == 4, F.concat(F.lit("] "), "w", F.lit(" ("))).otherwise(F.concat(F.lit(")"), "w", F.lit("[")))
    )
    return _digest(render.strip_label_wrappers(_items(spark, sf_dir, F.when(h < 2, "label").otherwise("roman"), value)))


@query(rf"""WITH {_ITEMS},
s AS (SELECT form_id, i, CASE WHEN h = 3 THEN 'roman' ELSE 'see' END AS k, CASE h WHEN 0 THEN 'II' WHEN 1 THEN ' 3 ' WHEN 2 THEN 'XI 4' ELSE w END AS v FROM h),
f AS (SELECT *, k = 'see' AND coalesce(lag(k) OVER (PARTITION BY form_id ORDER BY i), '') = 'see' AND regexp_full_match(trim(v), '[IVXLCDM]+( \d+)?|\d+') AS t FROM s),
g AS (SELECT *, sum(CASE WHEN t THEN 0 ELSE 1 END) OVER (PARTITION BY form_id ORDER BY i) AS isl FROM f),
z AS (SELECT form_id, min(i) AS i, arg_min(k, i) AS k, arg_min(v, i) || coalesce(' ' || string_agg(trim(v), ' ' ORDER BY i) FILTER (t), '') AS v FROM g GROUP BY form_id, isl)
SELECT form_id, {_SUM} FROM z GROUP BY form_id""")
def reference_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a reference that were kept as references of their own."""
    h = F.col("h")
    value = F.when(h == 0, "II").when(h == 1, " 3 ").when(h == 2, "XI 4").otherwise(F.col("w"))
    return _digest(render.collapse_reference_suffixes(_items(spark, sf_dir, F.when(h == 3, "roman").otherwise("see"), value)))


_LAST = "lower(split_part(p_name, ' ', 1))"


@query(f"""SELECT p_partkey AS sequence, CASE p_partkey % 5 WHEN 0 THEN 'cur' || p_partkey || ' ' ELSE 'root' || p_partkey || ' ' END || {_LAST} AS key, p_brand AS query FROM part WHERE p_partkey % 5 < 3""")
def phrase_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases that a form's templates stand for, and none from a run without an operator or in another style."""
    k, first = F.col("p_partkey") % 5, F.split_part("p_name", F.lit(" "), F.lit(1))
    value = F.when(k.isin(0, 3), F.concat(F.lit("~ "), first)).when(k == 1, F.concat(F.lit("– "), first)).otherwise(first)
    items = t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sequence"), F.col("p_brand").alias("canonical"), F.concat(F.lit("cur"), "p_partkey").alias("expression"), F.concat(F.lit("root"), "p_partkey").alias("root"),
        F.when(k == 3, "roman").otherwise("italic").alias("type"), value.alias("value"), F.lit("roman").alias("prev_type"), F.when(k == 2, "see –").otherwise("see").alias("prev_value"),
    )
    return resolve.content_index(items).filter("idx = 'phrase'").select("sequence", "key", "query")


@query(r"""WITH p AS (SELECT p_partkey AS ref_id, p_partkey % 4 AS k, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_size FROM part),
s AS (SELECT ref_id, CASE k WHEN 0 THEN [a || ' II', '4', b] WHEN 1 THEN [a, 'iv 2.', b || '.'] WHEN 2 THEN [a || '/' || b, 'XX'] ELSE [a, b, CAST(p_size AS VARCHAR)] END AS s FROM p)
SELECT ref_id, CAST(i - 1 AS BIGINT) AS seg, x AS text, NOT regexp_full_match(lower(x), '([ivxlcdm]+( \d+)?|\d+)\.?') AS is_target FROM (SELECT ref_id, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM s)""")
def reference_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference's targets; what is a number or a Roman number only is none.  Slashes split where all parts resolve."""
    k = F.col("p_partkey") % 4
    a, b = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    text = (
        F.when(k == 0, F.concat(a, F.lit(" II, 4;  "), b)).when(k == 1, F.concat(a, F.lit("; iv 2., "), b, F.lit("."))).when(k == 2, F.concat(a, F.lit("/"), b, F.lit(", XX")))
        .otherwise(F.concat(a, F.lit("/ "), b, F.lit(","), F.col("p_size").cast("string")))
    )
    refs = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("ref_id"), text.alias("text"))
    return resolve.segments(refs, refs.filter("ref_id % 4 = 3").select("ref_id")).select("ref_id", F.col("seg").cast("long").alias("seg"), "text", "is_target")


@query("""WITH f AS (SELECT p_partkey + 1 AS form_id, p_partkey // 4 + 1 AS entry_id, p_partkey % 4 AS k, p_partkey // 12 AS b, p_size FROM part),
g AS (SELECT *, CASE WHEN b % 2 = 0 THEN b * 3 + 1 ELSE entry_id END AS g, CASE WHEN b % 2 = 0 THEN 'e' || b || ' H' || entry_id ELSE 'e' || b END AS parent FROM f),
s AS (SELECT *, CASE WHEN k = 1 THEN 'd' ELSE 'h' END || (p_size % 2) AS x, CASE WHEN k = 1 THEN 'f' || form_id ELSE 'h' || (p_size % 2) END AS key FROM g WHERE k > 0),
u AS (SELECT g, key, min(x) AS x, min(form_id) AS first, string_agg(CAST(form_id AS VARCHAR), ',' ORDER BY form_id) AS ids FROM s GROUP BY g, key),
pa AS (SELECT g, key, string_agg(parent, '|' ORDER BY o) AS parents FROM (SELECT g, key, parent, min(form_id) AS o FROM s GROUP BY ALL) GROUP BY g, key),
n AS (SELECT g, x, min(first) AS o FROM u GROUP BY g, x),
c AS (SELECT g, string_agg(x, '|' ORDER BY o) AS children FROM n GROUP BY g),
e AS (SELECT g, min(b) AS b, string_agg(CAST(form_id AS VARCHAR), ',' ORDER BY form_id) FILTER (k = 0) AS ids, string_agg(CAST(form_id AS VARCHAR), ',' ORDER BY form_id) FILTER (k = 0 OR entry_id % 5 = 0) AS shown FROM g GROUP BY g),
r AS (SELECT g, -1 AS first, 'root' AS kind, 'e' || b AS root_expression, ids AS form_ids, shown AS display_ids, '' AS parents, coalesce(children, '') AS children, '' AS related FROM e LEFT JOIN c USING (g)
  UNION ALL SELECT u.g, first, 'subentry', 'e' || b, u.ids, u.ids, parents, '', coalesce((SELECT string_agg(n.x, '|' ORDER BY n.o) FROM n WHERE n.g = u.g AND n.x <> u.x), '') FROM u JOIN e ON e.g = u.g JOIN pa ON pa.g = u.g AND pa.key = u.key)
SELECT row_number() OVER (ORDER BY g, first) AS sequence, kind, root_expression, form_ids, display_ids, parents, children, related FROM r""")
def row_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered rows of roots and their derived groups, with parents, children and siblings; an empty root shows its derived forms."""
    p, i = t(spark, sf_dir, "part"), F.col("p_partkey")
    entry, k, block = F.floor(i / 4).cast("long") + 1, i % 4, F.floor(i / 12).cast("long")
    size = (F.col("p_size") % 2).cast("string")
    expression = F.when(k == 0, F.concat(F.lit("e"), block.cast("string"))).when(k == 1, F.concat(F.lit("d"), size)).otherwise(F.concat(F.lit("h"), size))
    homograph = F.when((k == 0) & (block % 2 == 0), F.concat(F.lit("H"), entry.cast("string"))).when(k == 2, "I").when(k == 3, "II")
    forms = p.select(
        entry.alias("entry_id"), (i + 1).alias("form_id"), F.when(k == 0, "entry").otherwise("subentry").alias("kind"), expression.alias("expression"), homograph.alias("homograph"),
        ((k > 0) | (entry % 5 != 0)).alias("has_content"),
    )
    ids = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    names = lambda c: F.array_join(c, "|").alias(c)
    return groups.row_groups(cut(forms, "forms"), nfc).select("sequence", "kind", "root_expression", ids("form_ids"), ids("display_ids"), names("parents"), names("children"), names("related"))


_STYLES = "CASE h WHEN 0 THEN 'italic' WHEN 1 THEN 'italic' WHEN 2 THEN 'bold' ELSE 'roman' END"


@query(rf"""WITH {_ITEMS},
s AS (SELECT form_id, i, {_STYLES} AS st, CASE h WHEN 0 THEN w || ')' WHEN 3 THEN w || ' ~ (' WHEN 4 THEN '– (' WHEN 5 THEN ') ' || w ELSE w END AS v FROM h),
n AS (SELECT *, lead(st) OVER x AS st1, lead(v) OVER x AS v1, lead(st, 2) OVER x AS st2, lead(v, 2) OVER x AS v2 FROM s WINDOW x AS (PARTITION BY form_id ORDER BY i)),
m AS (SELECT *, coalesce(st = 'roman' AND regexp_matches(v, '[~–]\s*\(\s*$') AND st1 = 'italic' AND (contains(v1, ')') OR coalesce(st2 = 'roman' AND regexp_matches(v2, '^\s*\)'), false)), false) AS hit FROM n),
z AS (SELECT form_id, i * 4 AS i, st AS k, v FROM m WHERE NOT hit UNION ALL SELECT form_id, i * 4, 'roman', trim(regexp_replace(v, '[~–]\s*\(\s*$', '')) FROM m WHERE hit AND trim(regexp_replace(v, '[~–]\s*\(\s*$', '')) <> ''
  UNION ALL SELECT form_id, i * 4 + 1, 'italic', regexp_extract(v, '([~–])\s*\(\s*$', 1) FROM m WHERE hit UNION ALL SELECT form_id, i * 4 + 2, 'roman', '(' FROM m WHERE hit)
SELECT form_id, {_SUM} FROM z GROUP BY form_id""")
def parenthesized_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An operator before an opening bracket and a closed italic phrase is a run of its own."""
    h = F.col("h")
    style = F.when(h < 2, "italic").when(h == 2, "bold").otherwise("roman")
    value = F.when(h == 0, F.concat("w", F.lit(")"))).when(h == 3, F.concat("w", F.lit(" ~ ("))).when(h == 4, "– (").when(h == 5, F.concat(F.lit(") "), "w")).otherwise(F.col("w"))
    items = _items(spark, sf_dir, style, value)
    events = items.select("form_id", F.col("item_ord").alias("ord"), F.lit("run").alias("kind"), F.col("type").alias("style"), "value", F.lit("").alias("boundary"))
    found = rewrite.split_parenthesized_operators(events)
    return _digest(found.select("form_id", F.col("ord").alias("item_ord"), F.col("style").alias("type"), "value"))
