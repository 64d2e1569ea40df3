"""Queries over the driver's tables, one per operator, each with its SQL.

The tables hold none of the lexicon's special syntax, so every query derives an
input that exercises its operator from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.functions import text as tx
from lexiforge.operators import forms as fo
from lexiforge.operators import groups as gr
from lexiforge.operators import ingest, linewrap, pack, render, resolve, rewrite, validate
from lexiforge.operators.ordered import running_sum
from lexiforge.sources import markers as mk
from lexiforge.sources import tables
from lexiforge.sources.scratch import cut

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- scalar functions -------------------------------------------------------
@query("""SELECT doc_id, replace(replace(g, '¤', 'fi'), '¶', 'fl') AS repaired,
  CAST(length(g) - length(replace(replace(g, '¤', ''), '¶', '')) AS BIGINT) AS n_repairs
FROM (SELECT doc_id, replace(replace(text, 'fi', '¤'), 'fl', '¶') AS g FROM documents)""")
def glyph_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.replace(F.replace("text", F.lit("fi"), F.lit("¤")), F.lit("fl"), F.lit("¶"))
    d = t(spark, sf_dir, "documents").select("doc_id", g.alias("g"))
    return d.select("doc_id", tx.repair_glyphs(F.col("g")).alias("repaired"), F.size(tx.glyph_log(F.col("g"))).cast("long").alias("n_repairs"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(trim(regexp_replace(g, '\s+', ' ', 'g')), '\s+([,.;:!?%\])])', '\1', 'g'), '([\[(])\s+', '\1', 'g') AS cleaned
FROM (SELECT doc_id, '  ( ' || replace(replace(text, ',', chr(9) || ' ,'), '.', ' .') || ' )' AS g FROM documents)""")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.concat(F.lit("  ( "), F.replace(F.replace("text", F.lit(","), F.lit("\t ,")), F.lit("."), F.lit(" .")), F.lit(" )"))
    return t(spark, sf_dir, "documents").select("doc_id", tx.clean_text(g).alias("cleaned"))


_WORDS = r"SELECT DISTINCT unnest(regexp_extract_all(text, '\p{L}+')) AS w FROM documents"


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("w")).distinct()


@query(f"""SELECT w, strip_accents(w) AS folded, replace(lower(strip_accents(w)), 'ß', 'ss') AS key FROM ({_WORDS})""")
def fold_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).select("w", tx.fold_latin(F.col("w")).alias("folded"), tx.fold_key(F.col("w")).alias("key"))


@query("""SELECT p_partkey, a || ' (' || b || ')' || c AS source, unnest([a || ' ' || c, a || ' ' || b || c]) AS e
FROM (SELECT p_partkey, p_brand AS a, lower(p_type) AS b, replace(p_name, ' ', '-') AS c FROM part)""")
def optional_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.concat("p_brand", F.lit(" ("), F.lower("p_type"), F.lit(")"), F.replace("p_name", F.lit(" "), F.lit("-")))
    return t(spark, sf_dir, "part").select("p_partkey", source.alias("source")).select("p_partkey", "source", F.explode(tx.expand_optional(F.col("source"))).alias("e"))


@query(f"""WITH w AS (SELECT w, strip_accents(w) AS f FROM ({_WORDS}) WHERE regexp_matches(w, '[éèêçñóíöüä]'))
SELECT w, f AS expression, CASE WHEN f <> w THEN w ELSE '' END AS reading FROM w
UNION ALL SELECT w, w, '' FROM w WHERE f <> w""")
def lookup_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _words(spark, sf_dir).filter(F.col("w").rlike("[éèêçñóíöüä]"))
    return w.select("w", F.explode(tx.lookup_candidates(F.array("w"))).alias("p")).select("w", "p.expression", "p.reading")


@query("""SELECT doc_id, CAST(1 + doc_id % 250 AS INTEGER) AS page FROM documents
WHERE 1 + doc_id % 250 BETWEEN 21 AND 30 OR 1 + doc_id % 250 = 70 OR 1 + doc_id % 250 BETWEEN 195 AND 200""")
def page_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand on the pages of a volume of 250, of which 200 are there; the selection is joined to them."""
    pages = tables.page_selection(spark, "21-30, 70,195-236,25", 200)
    laid = t(spark, sf_dir, "documents").select("doc_id", (1 + F.col("doc_id") % 250).cast("int").alias("page"))
    return laid.join(F.broadcast(pages), "page").select("doc_id", "page")  # at most 200 pages


@query(r"""WITH w AS (SELECT doc_id, upper(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS w FROM documents)
SELECT doc_id, count(*) AS n, count(*) FILTER (regexp_full_match(w, 'M{0,4}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})')) AS n_roman FROM w GROUP BY 1""")
def roman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = t(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("w"))
    return words.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(tx.valid_roman(F.upper("w"))).alias("n_roman"))


@query("""SELECT p_partkey, p_name AS expression, CASE WHEN p_partkey % 3 = 0 THEN 'IV' END AS homograph,
  CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size END AS INTEGER) AS sense, CASE WHEN p_partkey % 5 = 0 THEN '~' END AS operator FROM part""")
def expression_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    zone = F.concat("p_name", F.when(k % 3 == 0, " IV").otherwise(""), F.when(k % 2 == 0, F.concat(F.lit(" "), F.col("p_size").cast("string"))).otherwise(""), F.when(k % 5 == 0, " ~").otherwise(""))
    p = t(spark, sf_dir, "part").select("p_partkey", tx.parse_expression(zone, F.lit(""), F.lit(False)).alias("p"))
    return p.select("p_partkey", "p.expression", "p.homograph", F.col("p.initial_sense").alias("sense"), F.col("p.template_operator").alias("operator"))


@query("""SELECT p_partkey, replace('~ ' || lower(p_type), '~', p_name) || ' ' || p_brand || ' ' || p_brand AS resolved FROM part""")
def template_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.concat(F.lit("~ "), F.lower("p_type"), F.lit(" – –"))
    return t(spark, sf_dir, "part").select("p_partkey", tx.resolve_operators(value, F.col("p_brand"), F.col("p_name")).alias("resolved"))


@query("""SELECT page_id, replace(replace(url_encode(u), '%2F', '/'), '%7E', '~') AS quoted FROM (SELECT page_id, replace(url, '/', ' *~/') AS u FROM pages)""")
def url_quoting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "pages").select("page_id", tx.url_quote(F.replace("url", F.lit("/"), F.lit(" *~/"))).alias("quoted"))


@query("""SELECT doc_id, sha256(text) AS h, sha256(replace(replace(text, chr(10), chr(13) || chr(10)), chr(13) || chr(10), chr(10))) AS h_lf FROM documents""")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexiforge.operators.sinks import content_hash as digest

    d = t(spark, sf_dir, "documents")
    return d.select("doc_id", digest(F.col("text")).alias("h"), digest(F.replace("text", F.lit("\n"), F.lit("\r\n")), True).alias("h_lf"))


# ---- labels -----------------------------------------------------------------
_TAGS = [("en", "English", "#1"), ("fr", "French", "#2"), ("src1", "One", "#3"), ("src2", "Two", "#4"), ("De", "Upper", "#5")]
_TAG_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _TAGS) + ") tags(tag, tag_rename, color)"


def _tags(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_TAGS, "tag string, tag_rename string, color string")


@query(f"SELECT doc_id, coalesce(tag_rename, lang) AS shown, coalesce(color, '#626273') AS color FROM documents LEFT JOIN {_TAG_SQL} ON tag = lang")
def tag_join_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, named = t(spark, sf_dir, "documents"), _tags(spark)
    j = d.join(F.broadcast(named), F.col("lang") == F.col("tag"), "left")  # a dimension of five rows
    return j.select("doc_id", F.coalesce("tag_rename", "lang").alias("shown"), F.coalesce("color", F.lit(render.DEFAULT_COLOR)).alias("color"))


@query(f"""WITH l AS (SELECT DISTINCT lang || '/' || source AS v, lang AS a, source AS b FROM documents),
k AS (SELECT l.*, EXISTS (SELECT 1 FROM {_TAG_SQL} WHERE tag = a) AND EXISTS (SELECT 1 FROM {_TAG_SQL} WHERE tag = b) AS s FROM l)
SELECT v AS value, CAST(p AS INTEGER) AS pos, code, coalesce(tag_rename, code) AS shown FROM (
  SELECT v, 0 AS p, CASE WHEN s THEN a ELSE v END AS code FROM k UNION ALL SELECT v, 1, b FROM k WHERE s) LEFT JOIN {_TAG_SQL} ON tag = code""")
def tag_compound_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = t(spark, sf_dir, "documents").select(F.concat_ws("/", "lang", "source").alias("value"))
    return render.split_labels(labels, _tags(spark)).select("value", "pos", "code", "shown")


# ---- lines, entries, forms --------------------------------------------------
@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
g AS (SELECT doc_id, i, CAST(40 + (i * 13) % 700 AS DOUBLE) AS y, CASE WHEN length(s) % 3 = 0 THEN 'bold' ELSE 'roman' END AS style, CASE WHEN length(s) % 2 = 0 THEN 42.5 ELSE 264.9 END AS x, s FROM l)
SELECT doc_id, CAST(i AS INTEGER) AS line, CASE WHEN y < 50 THEN 'running_header' WHEN y > 690 THEN 'running_footer' WHEN s = '' THEN 'blank'
  WHEN style = 'bold' AND x = 42.5 THEN 'root_entry_start' WHEN style = 'bold' THEN 'subentry_start' ELSE 'continuation' END AS line_class FROM g""")
def line_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "s"))
    n = F.length("s")
    style = F.when(F.col("s") != "", F.when(n % 3 == 0, "bold").otherwise("roman"))
    y, x = (40 + (F.col("line") * 13) % 700).cast("double"), F.when(n % 2 == 0, 42.5).otherwise(264.9)
    return rows.select("doc_id", "line", ingest.classify(y, style, x).alias("line_class"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marker lines from conversations: a first turn is an entry, a user's a form."""
    c = t(spark, sf_dir, "conversations")
    marker = F.when(F.col("turn") == 0, "Entry").when(F.col("role") == "user", "Subentry").otherwise("Roman")
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("line_no"), marker.alias("marker"), F.col("text").alias("value"))


_TURNS = "SELECT conv_id * 1000 + turn AS line_no, CASE WHEN turn = 0 THEN 'Entry' WHEN role = 'user' THEN 'Subentry' ELSE 'Roman' END AS marker, text AS value FROM conversations"


@query(f"""SELECT line_no, marker, CAST(sum(CASE WHEN marker = 'Entry' THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS BIGINT) AS entry_id,
  CAST(sum(CASE WHEN marker <> 'Roman' THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS BIGINT) AS form_id FROM ({_TURNS})""")
def entry_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fo.assign_forms(_turns(spark, sf_dir)).select("line_no", "marker", "entry_id", "form_id")


@query(f"""WITH s AS (SELECT *, sum(CASE WHEN marker = 'Subentry' THEN 1 ELSE 0 END) OVER (PARTITION BY line_no // 1000 ORDER BY line_no) AS seg FROM ({_TURNS}))
SELECT line_no // 1000 AS form_id, CAST(seg AS BIGINT) AS seg, count(*) AS n_items FROM s WHERE marker = 'Roman' GROUP BY ALL""")
def sense_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _turns(spark, sf_dir)
    kind = F.when(F.col("marker") == "Subentry", "sense").when(F.col("marker") == "Roman", "roman").otherwise("note")
    items = m.select(F.floor(F.col("line_no") / 1000).alias("form_id"), F.col("line_no").alias("item_ord"), kind.alias("type"), F.lit("1").alias("value"))
    s = render.sense_segments(items).filter("type = 'roman'")
    return s.groupBy("form_id", F.col("seg").cast("long").alias("seg")).agg(F.count("*").alias("n_items"))


@query(f"""SELECT CAST(count(*) FILTER (marker = 'Entry') AS BIGINT) AS n_entries, CAST(count(*) FILTER (marker = 'Subentry') AS BIGINT) AS n_subentries,
  CAST(count(*) FILTER (marker = 'Roman') AS BIGINT) AS n_runs, count(*) AS n_lines FROM ({_TURNS})""")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, is_ = _turns(spark, sf_dir), lambda k: F.count_if(F.col("marker") == k)
    return m.agg(is_("Entry").alias("n_entries"), is_("Subentry").alias("n_subentries"), is_("Roman").alias("n_runs"), F.count("*").alias("n_lines"))


@query(f"""WITH l AS (SELECT line_no, CASE WHEN line_no % 7 = 0 THEN 'Sense' WHEN line_no % 11 = 0 THEN 'Odd' ELSE marker END AS marker FROM ({_TURNS}))
SELECT line_no, CASE WHEN line_no < (SELECT min(line_no) FROM l WHERE marker = 'Entry') THEN 'marker before the first entry' WHEN marker = 'Sense' THEN 'invalid sense number' ELSE 'unknown marker' END AS problem
FROM l WHERE marker IN ('Sense', 'Odd') OR line_no < (SELECT min(line_no) FROM l WHERE marker = 'Entry')""")
def marker_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("line_no")
    odd = F.when(n % 7 == 0, "Sense").when(n % 11 == 0, "Odd").otherwise(F.col("marker"))
    return mk.marker_errors(_turns(spark, sf_dir).withColumn("marker", odd).withColumn("value", F.lit("x")))


_ROOTS = "SELECT p_partkey + 0 AS entry_id, p_name AS expression, CASE WHEN p_size % 4 <> 0 THEN 'I' END AS homograph FROM part"


def _roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "part").select(F.col("p_partkey").alias("entry_id"), F.col("p_name").alias("expression"), F.when(F.col("p_size") % 4 != 0, "I").alias("homograph"))


@query(f"""WITH l AS (SELECT *, lag(expression) OVER (ORDER BY entry_id) AS pe, lag(homograph) OVER (ORDER BY entry_id) AS ph FROM ({_ROOTS}))
SELECT entry_id, CAST(sum(CASE WHEN expression = pe AND homograph IS NOT NULL AND ph IS NOT NULL THEN 0 ELSE 1 END) OVER (ORDER BY entry_id) AS BIGINT) AS group_ord FROM l""")
def homograph_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.entry_groups(_roots(spark, sf_dir)).select("entry_id", "group_ord")


@query("""WITH f AS (SELECT p_size AS g, p_partkey AS id, p_brand AS e, CASE WHEN p_partkey % 3 <> 0 THEN p_brand ELSE 'f' || p_partkey END AS k FROM part)
SELECT CAST(g AS BIGINT) AS group_ord, min(id) AS first_form, arg_min(e, id) AS expression, count(*) AS n_forms FROM f GROUP BY g, k""")
def subentry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.subentry_groups(_derived(spark, sf_dir)).select("group_ord", "first_form", "expression", F.size("form_ids").cast("long").alias("n_forms"))


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return t(spark, sf_dir, "part").select(
        F.col("p_size").cast("long").alias("group_ord"), k.alias("form_id"), F.col("p_brand").alias("expression"), F.when(k % 3 != 0, "I").alias("homograph"),
        F.lit("r").alias("root_expression"), F.lit(None).cast("string").alias("root_homograph"),
    )


@query("""WITH f AS (SELECT p_size AS g, p_brand AS e, min(p_partkey) AS id FROM part GROUP BY ALL)
SELECT CAST(g AS BIGINT) AS group_ord, string_agg(e, '|' ORDER BY id) AS children FROM f GROUP BY g""")
def siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.children(gr.subentry_groups(_derived(spark, sf_dir))).select("group_ord", F.array_join("children", "|").alias("children"))


# ---- sequence rewrites ------------------------------------------------------
@query("""WITH r AS (SELECT source, doc_id, lang, CASE WHEN lag(lang) OVER w = lang THEN 0 ELSE 1 END AS n FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)),
i AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY doc_id) AS isl FROM r)
SELECT source AS form_id, min(doc_id) AS ord, any_value(lang) AS style, string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY doc_id) AS value FROM i GROUP BY source, isl""")
def run_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    events = d.select(F.col("source").alias("form_id"), F.col("doc_id").alias("ord"), F.lit("run").alias("kind"), F.col("lang").alias("style"), F.col("doc_id").cast("string").alias("value"), F.lit(" ").alias("boundary"))
    return rewrite.coalesce_runs(events).select("form_id", "ord", "style", "value")


@query("""WITH l AS (SELECT conv_id, turn, 'Bold' AS m, 'wo ' || (turn + 1) AS v FROM conversations WHERE turn % 2 = 0 UNION ALL SELECT conv_id, turn, 'Sense', CAST(turn + 1 AS VARCHAR) FROM conversations WHERE turn % 2 = 1),
n AS (SELECT *, lead(CASE WHEN m = 'Sense' THEN turn + 1 END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS nx FROM l)
SELECT conv_id AS form_id, m AS marker, count(*) AS n FROM (
  SELECT conv_id, CASE WHEN m = 'Bold' AND nx = turn + 2 THEN 'Sense' ELSE m END AS m FROM n UNION ALL SELECT conv_id, 'Bold' FROM n WHERE m = 'Bold' AND nx = turn + 2) GROUP BY ALL""")
def embedded_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = t(spark, sf_dir, "conversations"), F.col("turn") % 2 == 0
    n = (F.col("turn") + 1).cast("string")
    lines = c.select(F.col("conv_id").alias("form_id"), F.col("turn").alias("ord"), F.when(k, "Bold").otherwise("Sense").alias("marker"), F.when(k, F.concat(F.lit("wo "), n)).otherwise(n).alias("value"))
    return rewrite.promote_embedded_senses(lines).groupBy("form_id", "marker").agg(F.count("*").alias("n"))


# the state machine as a walk over the lines of each form; a first number above 1 gets a first sense after the first line
@query(r"""WITH RECURSIVE l AS (SELECT conv_id AS form_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) * 2 AS o, CASE WHEN role = 'user' THEN turn % 3 + 1 END AS n, text, regexp_matches(text, '\p{L}') AS letter FROM conversations),
b AS (SELECT * FROM l UNION ALL SELECT form_id, 3, 1, NULL, NULL FROM (SELECT form_id, arg_min(n, o) FILTER (n IS NOT NULL) AS n FROM l GROUP BY form_id) WHERE n > 1),
q AS (SELECT *, row_number() OVER (PARTITION BY form_id ORDER BY o) AS i FROM b),
s(form_id, i, prev, bold, local, last, marker, value) AS (SELECT DISTINCT form_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), false, false, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM q
  UNION ALL SELECT form_id, i, CASE WHEN n IS NULL THEN prev WHEN first OR resumes THEN n WHEN grows THEN least(n, prev + 1) ELSE prev END, CASE WHEN n IS NULL THEN bold OR letter ELSE bold AND NOT (first OR resumes OR grows OR restart) END,
    CASE WHEN n IS NULL THEN local ELSE (local OR restart) AND NOT resumes END, CASE WHEN n IS NULL THEN last WHEN resumes THEN NULL WHEN restart OR local THEN n ELSE last END,
    CASE WHEN n IS NULL THEN 'Bold' WHEN first OR resumes THEN 'Sense' WHEN local OR restart OR n < prev THEN 'Bold' WHEN n > prev THEN 'Sense' END,
    CASE WHEN n IS NULL THEN text WHEN first OR resumes OR local OR restart OR n < prev THEN CAST(n AS VARCHAR) ELSE CAST(least(n, prev + 1) AS VARCHAR) END
  FROM (SELECT *, NOT local AND NOT restart AND coalesce(n > prev, false) AS grows FROM (SELECT s.form_id, q.i, s.prev, s.bold, s.local, s.last, q.n, q.text, q.letter, q.n IS NOT NULL AND s.prev IS NULL AS first,
    coalesce(s.local AND q.n = s.prev + 1 AND (s.last IS NULL OR q.n <> s.last + 1), false) AS resumes, coalesce(NOT s.local AND q.n <= s.prev AND s.bold, false) AS restart FROM s JOIN q ON q.form_id = s.form_id AND q.i = s.i + 1)))
SELECT form_id, row_number() OVER (PARTITION BY form_id ORDER BY i) - 1 AS ord, marker, value FROM s WHERE marker IS NOT NULL""")
def sense_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations")
    value = F.when(F.col("role") == "user", F.col("turn") % 3 + 1).cast("string")
    lines = c.select(F.col("conv_id").alias("form_id"), F.col("turn").alias("ord"), F.when(value.isNotNull(), "Sense").otherwise("Bold").alias("marker"), F.coalesce(value, F.col("text")).alias("value"))
    return rewrite.sense_boundaries(lines)


@query("""SELECT form_id, string_agg(line, '|' ORDER BY o, k) AS lines FROM (
  SELECT conv_id AS form_id, turn AS o, 0 AS k, CASE WHEN role = 'user' AND nx = 'assistant' THEN '[Pair]' ELSE '[' || role || ']' END AS line
  FROM (SELECT *, lead(role) OVER w AS nx, lag(role) OVER w AS pv FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE NOT (role = 'assistant' AND coalesce(pv, '') = 'user')) GROUP BY form_id""")
def sequence_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("form_id"), F.col("turn").alias("ord"), F.concat(F.lit("["), "role", F.lit("]")).alias("line"))
    out = rewrite.replace_sequences(c, [(("[user]", "[assistant]"), ("[Pair]",))])
    return out.groupBy("form_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "|").alias("lines"))


# ---- line wraps -------------------------------------------------------------
_WRAP = r"""w AS (SELECT item_id, unnest(regexp_extract_all(text, '\p{L}+')) AS s, generate_subscripts(regexp_extract_all(text, '\p{L}+'), 1) - 1 AS i FROM benchmark),
c AS (SELECT item_id, i, 'a' || item_id || '-' || i AS pl, 'b' || item_id || '-' || i AS nl, left(s, 2) AS l, substr(s, 3) || CASE WHEN i % 5 = 0 THEN 'x' ELSE '' END AS r FROM w WHERE length(s) >= 4),
v AS (SELECT DISTINCT replace(lower(unnest(regexp_extract_all(text, '\p{L}+'))), 'ß', 'ss') AS word FROM documents),
d AS (SELECT c.*, l || r AS j, l || '-' || r AS h, i % 10 = 0 AS reviewed, replace(lower(l || r), 'ß', 'ss') IN (SELECT word FROM v) AS k FROM c),
a AS (SELECT *, CASE WHEN k THEN 'remove_hyphen' WHEN NOT reviewed THEN 'ambiguous' WHEN i % 20 = 0 THEN 'conflict' ELSE 'preserve_hyphen' END AS action FROM d)"""


def _wraps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    b = t(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("i", "s")).filter(F.length("s") >= 4)
    name = lambda p: F.concat(F.lit(p), F.col("item_id").cast("string"), F.lit("-"), F.col("i").cast("string"))
    pairs = b.select(
        "item_id", "i", name("a").alias("previous_line_id"), name("b").alias("next_line_id"), F.substring("s", 1, 2).alias("left_fragment"),
        F.concat(F.expr("substring(s, 3)"), F.when(F.col("i") % 5 == 0, "x").otherwise("")).alias("right_fragment"),
    )
    joined = F.concat("left_fragment", "right_fragment")
    res = pairs.filter("i % 10 = 0").select(
        tx.wrap_key(F.col("previous_line_id"), F.col("next_line_id"), F.col("left_fragment"), F.col("right_fragment")).alias("resolution_key"),
        F.when(F.col("i") % 20 == 0, "other").otherwise(joined).alias("joined_candidate"),
        F.concat_ws("-", "left_fragment", "right_fragment").alias("hyphenated_candidate"), F.lit(" preserve_hyphen ").alias("approved_resolution"),
    )
    words, hyphenated = linewrap.word_evidence(t(spark, sf_dir, "documents"))
    return linewrap.decide(pairs, words, hyphenated, res), res, pairs


@query(f"WITH {_WRAP} SELECT pl AS previous_line_id, j AS joined_candidate, action, CASE action WHEN 'remove_hyphen' THEN j WHEN 'preserve_hyphen' THEN h END AS replacement FROM a")
def line_wrap_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wraps(spark, sf_dir)[0].select("previous_line_id", "joined_candidate", "action", "replacement")


@query(f"WITH {_WRAP} SELECT action, count(*) AS n FROM a GROUP BY 1")
def line_wrap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, res, _ = _wraps(spark, sf_dir)
    row = linewrap.audit(d, linewrap.unmatched(res, d))
    names = ("remove_hyphen", "preserve_hyphen", "ambiguous", "conflict")
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("action"), F.col(f"n_{a}").alias("n")) for a in names])).alias("x")).select("x.*").filter("n > 0")


@query(f"WITH {_WRAP} SELECT pl || '|' || nl || '|' || lower(l) || '|' || replace(lower(r), 'ß', 'ss') AS resolution_key FROM a WHERE reviewed AND action NOT IN ('remove_hyphen', 'preserve_hyphen')")
def unmatched_resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, res, _ = _wraps(spark, sf_dir)
    return linewrap.unmatched(res, d.filter("action in ('remove_hyphen', 'preserve_hyphen')"))


# ---- references -------------------------------------------------------------
def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct first words and first pairs of words of all documents' lines are its spellings."""
    lines = t(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("s"))
    pair = F.regexp_extract("s", r"^(\p{L}+ \p{L}+)", 1)
    found = lines.select(F.explode(F.array(F.regexp_extract("s", r"^(\p{L}+)", 1), pair)).alias("w")).filter("w <> ''").distinct()
    return found.select(F.xxhash64("w").alias("sequence"), F.array("w").alias("spellings"))


_DICT = r"""s AS (SELECT unnest(string_split(text, chr(10))) AS s FROM documents),
dict AS (SELECT DISTINCT w FROM (SELECT regexp_extract(s, '^(\p{L}+)', 1) AS w FROM s UNION ALL SELECT regexp_extract(s, '^(\p{L}+ \p{L}+)', 1) FROM s) WHERE w <> ''),
cand AS (SELECT w, strip_accents(w) AS q, strip_accents(w) AS canon FROM dict UNION SELECT w, w, strip_accents(w) FROM dict),
lk AS (SELECT DISTINCT replace(lower(q), 'ß', 'ss') AS key, q, w FROM cand),
goal AS (SELECT key, string_agg(DISTINCT w, '|' ORDER BY w) AS goal FROM lk GROUP BY key),
nt AS (SELECT replace(lower(strip_accents(w)), 'ß', 'ss') AS key, strip_accents(w) AS q FROM dict),
pf AS (SELECT split_part(key, ' ', 1) AS key, q FROM nt WHERE key LIKE '% %'),
em AS (SELECT unnest([a, b]) AS key, q FROM (SELECT split_part(key, ' ', 1) AS a, split_part(key, ' ', 2) AS b, q FROM nt WHERE key LIKE '% %') WHERE length(a) >= 3 AND length(b) >= 3 AND (contains(a, b) OR contains(b, a))),
r AS (SELECT item_id * 1000 + i AS ref_id, w AS v, CASE WHEN i % 2 = 0 THEN upper(w) || ' II.' ELSE w END AS text FROM (
  SELECT item_id, unnest(regexp_extract_all(text, '\p{L}+')) AS w, generate_subscripts(regexp_extract_all(text, '\p{L}+'), 1) - 1 AS i FROM benchmark)),
k AS (SELECT ref_id, text, replace(lower(strip_accents(v)), 'ß', 'ss') AS key FROM r),
hit AS (SELECT ref_id, 30 AS stage, 'exact' AS method, key, q FROM k JOIN lk USING (key) UNION SELECT ref_id, 40, 'source-notation', key, q FROM k JOIN nt USING (key)
  UNION SELECT ref_id, 110, 'embedded-form', key, q FROM k JOIN em USING (key) UNION SELECT ref_id, 120, 'unique-prefix', key, q FROM k JOIN pf USING (key)),
u AS (SELECT ref_id, stage, method, count(DISTINCT replace(lower(q), 'ß', 'ss')) AS n, count(DISTINCT goal.goal) AS g, arg_min(q, (length(q), q)) AS query FROM hit JOIN goal ON goal.key = replace(lower(q), 'ß', 'ss') GROUP BY ALL),
best AS (SELECT ref_id, arg_min(method, stage) AS method, arg_min(query, stage) AS query FROM u WHERE n = 1 OR g = 1 GROUP BY ref_id)"""


def _refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = t(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("i", "w"))
    return b.select((F.col("item_id") * 1000 + F.col("i")).alias("ref_id"), F.when(F.col("i") % 2 == 0, F.concat(F.upper("w"), F.lit(" II."))).otherwise(F.col("w")).alias("text"))


def _cascade(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    refs = _refs(spark, sf_dir)
    return refs, resolve.resolve(refs, cut(resolve.spellings_index(_dictionary(spark, sf_dir)), "index"))


@query(f"WITH {_DICT} SELECT ref_id, method, query FROM best")
def xref_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir)[1]


@query("""WITH p AS (SELECT p_brand AS target, split_part(p_name, ' ', 1) AS e, min(p_partkey) AS o, count(*) AS c FROM part GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY o) AS k FROM p)
SELECT target, CAST(sum(c) AS BIGINT) AS n, string_agg(e, '|' ORDER BY o) FILTER (WHERE k <= 5) AS examples FROM r GROUP BY target""")
def unresolved_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as targets nothing resolves, the first words of their parts' names as examples."""
    lost = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("target"), F.substring_index("p_name", " ", 1).alias("example"))
    return resolve.unresolved_targets(lost).withColumn("examples", F.array_join("examples", "|"))


@query(f"WITH {_DICT} SELECT coalesce(method, 'unresolved') AS method, count(*) AS n FROM r LEFT JOIN best USING (ref_id) GROUP BY 1")
def xref_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, found = _cascade(spark, sf_dir)
    return refs.join(found, "ref_id", "left").groupBy(F.coalesce("method", F.lit("unresolved")).alias("method")).agg(F.count("*").alias("n"))


@query(f"WITH {_DICT} SELECT key, min(q) AS query FROM pf GROUP BY key HAVING count(DISTINCT q) = 1")
def unique_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = resolve.spellings_index(_dictionary(spark, sf_dir)).filter("idx = 'prefix'")
    return index.groupBy("key").agg(F.countDistinct("query").alias("_n"), F.min("query").alias("query")).filter("_n = 1").drop("_n")


# ---- rendering, links, packing ---------------------------------------------
@query(r"""WITH w AS (SELECT item_id, unnest(regexp_extract_all(text, '\p{L}+|[.,]')) AS s, generate_subscripts(regexp_extract_all(text, '\p{L}+|[.,]'), 1) AS i FROM benchmark)
SELECT item_id AS form_id, string_agg(CASE WHEN i > 1 AND s NOT IN ('.', ',') THEN ' ' ELSE '' END || s, '' ORDER BY i) AS line FROM w GROUP BY 1""")
def token_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = t(spark, sf_dir, "benchmark").select("item_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"\p{L}+|[.,]"), F.lit(0))).alias("i", "s"))
    tok = b.select(F.col("item_id").alias("form_id"), F.lit(0).alias("seg"), F.col("i").cast("long").alias("tok_ord"), F.col("s").alias("surface"), F.lit("roman").alias("kind"))
    s = render.spaced(tok).withColumn("p", F.when(F.col("space"), F.concat(F.lit(" "), "surface")).otherwise(F.col("surface")))
    return s.groupBy("form_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tok_ord", "p"))), lambda x: x["p"]), "").alias("line"))


@query("""SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages""")
def href_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.hrefs(t(spark, sf_dir, "pages").select("page_id", "html"), "html")


@query(r"""WITH l AS (SELECT substr(unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)), 2) AS q FROM pages), e AS (SELECT DISTINCT unnest(string_split_regex(text, '[ \n]+')) AS x FROM benchmark)
SELECT q AS query, count(*) AS n FROM l WHERE q NOT IN (SELECT x FROM e) GROUP BY 1""")
def link_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = validate.hrefs(t(spark, sf_dir, "pages").select("html"), "html", r"href=\"(/[^\"]*)\"").select(F.concat(F.lit("?query="), F.expr("substring(href, 2)"), F.lit("&wildcards=off")).alias("href"))
    words = t(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "[ \n]+")).alias("expression"))
    return validate.dangling(links, words)


_PACK = """RECURSIVE o AS (SELECT row_number() OVER (ORDER BY doc_id) AS i, doc_id, strlen(text) AS n FROM documents),
p(i, doc_id, n, bank, used) AS (SELECT i, doc_id, n, CAST(1 AS BIGINT), 3 + n FROM o WHERE i = 1
  UNION ALL SELECT o.i, o.doc_id, o.n, CASE WHEN used + 1 + o.n >= 200000 THEN bank + 1 ELSE bank END, CASE WHEN used + 1 + o.n >= 200000 THEN 3 + o.n ELSE used + 1 + o.n END FROM p JOIN o ON o.i = p.i + 1)"""


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("n"))
    return pack.pack(d, "doc_id", "n", 200_000)


@query(f"WITH {_PACK} SELECT doc_id, bank FROM p")
def bank_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir).select("doc_id", "bank")


@query(f"WITH {_PACK} SELECT bank, count(*) AS n_rows, CAST(sum(n) + count(*) - 1 + 3 AS BIGINT) AS n_bytes FROM p GROUP BY bank")
def bank_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.bank_sizes(_packed(spark, sf_dir), "n").select("bank", "n_rows", F.col("n_bytes").cast("long").alias("n_bytes"))


@query("SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 300 + 1 AS BIGINT) AS bank FROM documents")
def fixed_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = running_sum(t(spark, sf_dir, "documents").select("doc_id"), "doc_id", F.lit(1), "k")
    return pack.fixed_banks(d, "k", 300).select("doc_id", "bank")


def _all() -> None:
    from . import normal, reviewed, spans, structure  # noqa: F401  they register their queries here


def queries() -> dict[str, Query]:
    _all()
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_SQL)


__all__ = ["oracle_sql", "queries"]
