"""Queries from spans to events over a span table derived from ``documents``, each with its SQL.

A document is a form, its lines are lines, its words spans; a rule on the length
and place of a word gives style and text, so that all states are met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.operators import events as ev
from lexiforge.plans.registry import query, t
from lexiforge.sources.scratch import cut

#: Bytes of text whose spans one task sorts (about 150,000 rows), so that sorts and the buffers of windows fit together.
TASK_BYTES = 1 << 20
KNOWN = ("T", "S", "D", "the", "de", "la", "of", "and", "der", "und")

#: (styles of 18 kinds of spans, their texts in Spark's and in DuckDB's words): fixed values of the carrier.
_KINDS = (
    ("bold", "concat(w, ' ')", "w || ' '"), ("bold", "concat(w, ' ')", "w || ' '"), ("bold", "concat(' ', length(w))", "' ' || length(w)"),
    ("roman", "'.'", "'.'"), ("roman", "' . '", "' . '"), ("roman", "concat('. ', w)", "'. ' || w"),
    ("italic", "upper(left(replace(w, 'ß', 's'), 1))", "upper(left(replace(w, 'ß', 's'), 1))"), ("italic", "upper(left(replace(w, 'ß', 's'), 1))", "upper(left(replace(w, 'ß', 's'), 1))"), ("italic", "concat(upper(left(replace(w, 'ß', 's'), 1)), ' ')", "upper(left(replace(w, 'ß', 's'), 1)) || ' '"),
    ("roman", "' ~ '", "' ~ '"), ("italic", "concat('(', w, ')')", "'(' || w || ')'"), ("roman", "w", "w"), ("roman", "' and '", "' and '"), ("roman", "'-'", "'-'"),
    ("bold", "'II'", "'II'"), ("symbol", "'→'", "'→'"), ("small_caps", "concat(upper(replace(w, 'ß', 's')), '-')", "upper(replace(w, 'ß', 's')) || '-'"), ("roman", "' '", "' '"),
)


def _case(kind: str, of: int) -> str:
    return f"CASE {kind} " + " ".join(f"WHEN {k} THEN {v[of] if of else repr(v[0])}" for k, v in enumerate(_KINDS)) + " END"


def texts_by(texts: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, int]:
    """``texts`` exchanged by ``key`` before words become rows, so that the rows need no exchange; into how many partitions."""
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = 1 + size // TASK_BYTES
    return texts.repartition(parts, key), parts


def line_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """form_id, line_ord, line; exchanged by form into so many partitions."""
    texts, parts = texts_by(t(spark, sf_dir, "documents").select(F.col("doc_id").alias("form_id"), "text"), "form_id")
    return texts.select("form_id", F.posexplode(F.split("text", "\n")).alias("line_ord", "line")), parts


def _line_id() -> Column:
    return F.concat_ws("-", "form_id", "line_ord")


def span_table(lines: DataFrame) -> DataFrame:
    words = lines.select("form_id", "line_ord", (F.length("line") % 2 == 1).alias("join_next"), F.posexplode(F.split("line", " ")).alias("span_ord", "w"))
    words = words.withColumn("h", (F.length("w") * 7 + F.col("span_ord") * 5 + F.col("line_ord") * 3) % len(_KINDS))
    x = F.col("span_ord") * 10.0
    return words.select(
        "form_id", "line_ord", _line_id().alias("line_id"), "span_ord", F.expr(_case("h", 0)).alias("style"), F.expr(_case("h", 1)).alias("clean_text"),
        x.alias("x0"), (x + F.when(F.length("w") % 2 == 0, 9.5).otherwise(8.0)).alias("x1"), "join_next",
    )


_SPANS = f"""l AS (SELECT doc_id AS form_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS j FROM documents),
w AS (SELECT form_id, j, length(line) % 2 = 1 AS open, unnest(string_split(line, ' ')) AS w, generate_subscripts(string_split(line, ' '), 1) - 1 AS i FROM l),
h AS (SELECT *, (length(w) * 7 + i * 5 + j * 3) % {len(_KINDS)} AS h FROM w),
s AS (SELECT form_id, j, i, open, {_case('h', 0)} AS style, {_case('h', 2)} AS x, length(w) % 2 = 0 AS near FROM h)"""

# the spans of the first line that are not blank, in order; a recursive walk accepts one after another
_ZONE = rf"""{_SPANS},
v AS (SELECT *, row_number() OVER (PARTITION BY form_id ORDER BY i) AS n FROM s WHERE j = 0 AND trim(x) <> ''),
b AS (SELECT form_id, min(n) AS n FROM v WHERE style = 'bold' GROUP BY form_id),
z(form_id, n) AS (SELECT form_id, n FROM b UNION ALL SELECT z.form_id, CASE WHEN y.style = 'bold' THEN y.n ELSE q.n END FROM z JOIN v y ON y.form_id = z.form_id AND y.n = z.n + 1
  LEFT JOIN v q ON q.form_id = z.form_id AND q.n = z.n + 2
  WHERE (y.style = 'bold' AND NOT regexp_full_match(trim(y.x), '[0-9]+'))
    OR (y.style = 'roman' AND q.style = 'bold' AND NOT regexp_full_match(trim(q.x), '[0-9]+') AND (trim(q.x) = 'II' OR regexp_full_match(trim(y.x), '[./''’-]+')))),
e AS (SELECT form_id, min(n) AS first, max(n) AS last FROM z GROUP BY form_id),
p AS (SELECT form_id, (SELECT i FROM v WHERE v.form_id = e.form_id AND n = first) AS a, (SELECT i FROM v WHERE v.form_id = e.form_id AND n = last) AS c FROM e)"""


@query(rf"""WITH RECURSIVE {_ZONE}
SELECT s.form_id, coalesce(string_agg(x, '' ORDER BY i) FILTER (j = 0 AND i BETWEEN a AND c), '') AS zone_text, count(*) FILTER (j = 0 AND i < a) AS n_before,
  count(*) FILTER (j > 0 OR a IS NULL OR i > c) AS n_rest FROM s LEFT JOIN p USING (form_id) GROUP BY s.form_id""")
def leading_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest accepted prefix of a form's first line."""
    lines, parts = line_table(spark, sf_dir)
    rows = ev.mark_zones(span_table(lines), parts)
    zone = F.transform(F.array_sort(F.collect_list(F.when(F.col("zone") == "zone", F.struct("span_ord", "clean_text")))), lambda x: x["clean_text"])
    return rows.groupBy("form_id").agg(F.concat_ws("", zone).alias("zone_text"), F.count_if(F.col("zone") == "before").alias("n_before"), F.count_if(F.col("zone") == "rest").alias("n_rest"))


@query(rf"""WITH RECURSIVE {_ZONE},
r AS (SELECT form_id, style, x, row_number() OVER (PARTITION BY form_id ORDER BY i) AS n FROM v JOIN p USING (form_id) WHERE i > c),
g(form_id, n) AS (SELECT form_id, 1 FROM p UNION ALL SELECT g.form_id, g.n + 1 FROM g JOIN r USING (form_id, n)
  WHERE NOT (style = 'bold' AND regexp_full_match(trim(x), '[0-9]+')) AND NOT (style = 'roman' AND NOT regexp_matches(trim(lower(x)), '^\.$|(^|\s)(and|or)$')))
SELECT form_id, n AS place, trim(x) AS alias FROM g JOIN r USING (form_id, n) WHERE style = 'bold' AND NOT regexp_full_match(trim(x), '[0-9]+') AND trim(x) <> 'II'""")
def header_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bold forms of the header until prose starts; a lone Roman number names no form."""
    # headers are first lines: what the zones of other lines are has no part in them
    lines, parts = line_table(spark, sf_dir)
    marked = cut(ev.mark_zones(span_table(lines.filter("line_ord = 0")), parts), "zones")
    rest = marked.filter("line_ord = 0 and zone = 'rest'").filter(ev.shown(F.col("clean_text")))
    place = F.row_number().over(ev.Window.partitionBy("form_id").orderBy("span_ord"))
    numbered = rest.select(F.col("form_id").alias("_f"), F.col("span_ord").alias("_s"), place.cast("long").alias("place"))
    found = ev.header_aliases(marked)
    return found.join(numbered, (F.col("form_id") == F.col("_f")) & (F.col("span_ord") == F.col("_s"))).select("form_id", "place", "alias")


# chains of initials by a walk over the spans that are not blank, then the spans as they are after merging
_MERGED = rf"""{_SPANS},
v AS (SELECT *, row_number() OVER (PARTITION BY form_id, j ORDER BY i) AS n, CASE WHEN style = 'italic' AND regexp_full_match(trim(x), '[A-Z]') THEN 'i' WHEN style = 'roman' AND trim(x) = '.' THEN 'p'
  WHEN style = 'roman' AND regexp_matches(x, '^\s*\.') THEN 's' ELSE 'o' END AS k FROM s WHERE trim(x) <> ''),
t AS (SELECT form_id, j, string_agg(k, '' ORDER BY n) AS t FROM v GROUP BY form_id, j),
a(form_id, j, n, m) AS (SELECT form_id, j, n, n + 2 FROM v JOIN t USING (form_id, j) WHERE substr(t, n, 3) = 'ipi' AND (n < 3 OR substr(t, n - 2, 3) <> 'ipi')
  UNION ALL SELECT a.form_id, a.j, a.n, a.m + 2 FROM a JOIN t USING (form_id, j) WHERE substr(t, a.m, 3) = 'ipi'),
c AS (SELECT form_id, j, n, max(m) + 1 AS m FROM a GROUP BY form_id, j, n),
g AS (SELECT c.form_id, c.j, f.i AS a, l.i AS b FROM c JOIN v f ON f.form_id = c.form_id AND f.j = c.j AND f.n = c.n JOIN v l ON l.form_id = c.form_id AND l.j = c.j AND l.n = c.m WHERE l.k IN ('p', 's')),
u AS (SELECT s.form_id, s.j, s.i, s.open, s.style, s.x, s.near, g.a, g.b FROM s LEFT JOIN g ON g.form_id = s.form_id AND g.j = s.j AND s.i BETWEEN g.a AND g.b),
m AS (SELECT form_id, j, a * 2 AS i, bool_or(open) AS open, 'italic' AS style, trim(regexp_replace(regexp_replace(string_agg(CASE WHEN i = b THEN regexp_extract(x, '^\s*\.') ELSE x END, '' ORDER BY i), '\s+', ' ', 'g'), '\s+\.', '.', 'g')) AS x,
    arg_min(near, i) AS near, a AS place FROM u WHERE a IS NOT NULL GROUP BY form_id, j, a
  UNION ALL SELECT form_id, j, a * 2 + 1, open, style, regexp_replace(x, '^\s*\.', ''), near, i FROM u WHERE i = b AND regexp_replace(x, '^\s*\.', '') <> ''
  UNION ALL SELECT form_id, j, i * 2, open, style, x, near, i FROM u WHERE a IS NULL),
n AS (SELECT *, lag(struct_pack(j := j, style := style, x := x)) OVER (PARTITION BY form_id ORDER BY j, i) AS p, lead(struct_pack(j := j, style := style, x := x)) OVER (PARTITION BY form_id ORDER BY j, i) AS q FROM m WHERE trim(x) <> ''),
pr AS (SELECT *, style = 'italic' AND (coalesce(p.style = 'roman' AND p.j >= j - 1 AND regexp_matches(p.x, '~\s*$'), false) OR coalesce(p.j = j AND p.style = 'roman' AND regexp_matches(p.x, '\.\s*$'), false)
  OR coalesce(q.j = j AND q.style = 'roman' AND regexp_matches(q.x, '^\s*\.'), false)) AS protected FROM n)"""


@query(rf"""WITH RECURSIVE {_MERGED}
SELECT form_id, j AS line_ord, count(*) AS n_spans, count(*) FILTER (protected) AS n_protected, string_agg(CASE WHEN protected THEN '<' || x || '>' WHEN regexp_matches(x, '[A-Z]\.') THEN x END, '|' ORDER BY i) AS found
FROM pr GROUP BY form_id, j HAVING count(*) FILTER (protected) > 0 OR count(*) FILTER (regexp_matches(x, '[A-Z]\.')) > 0""")
def label_protection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: dotted initials merged, operands of templates (also over the end of a line) and parts of names protected."""
    lines, parts = line_table(spark, sf_dir)
    rows = ev.protect_labels(ev.merge_initials(span_table(lines), parts))
    rows = rows.filter(ev.shown(F.col("clean_text")))
    dotted = F.col("clean_text").rlike(r"[A-Z]\.")
    found = F.when(F.col("protected"), F.concat(F.lit("<"), "clean_text", F.lit(">"))).when(dotted, F.col("clean_text"))
    marks = F.transform(F.array_sort(F.collect_list(F.when(found.isNotNull(), F.struct("span_ord", found.alias("x"))))), lambda s: s["x"])
    out = rows.groupBy("form_id", F.col("line_ord").cast("long").alias("line_ord")).agg(
        F.count("*").alias("n_spans"), F.count_if("protected").alias("n_protected"), F.array_join(marks, "|").alias("found"), F.count_if(dotted).alias("_d")
    )
    return out.filter("n_protected > 0 or _d > 0").drop("_d")


def _decisions(lines: DataFrame) -> DataFrame:
    action = F.when(F.col("line_ord") % 3 == 0, "remove_hyphen").when(F.col("line_ord") % 3 == 1, "ambiguous").otherwise("preserve_hyphen")
    return lines.select("form_id", "line_ord").filter("line_ord % 5 < 4").withColumn("action", action)


_KNOWN_SQL = ", ".join(f"'{k}'" for k in KNOWN)
_EVENTS = rf"""{_SPANS.replace("s AS (SELECT form_id, j, i, open", "s0 AS (SELECT form_id, j, i, open")},
d AS (SELECT DISTINCT form_id, j, CASE j % 3 WHEN 0 THEN 'r' WHEN 1 THEN 'x' ELSE 'p' END AS act FROM s0 WHERE j % 5 < 4),
y AS (SELECT form_id, j, max(i) FILTER (trim(x) <> '') AS last FROM s0 GROUP BY form_id, j),
s AS (SELECT s0.form_id, s0.j, i, open, style, CASE WHEN act = 'r' AND i = last THEN regexp_replace(x, '-\s*$', '') ELSE x END AS x, near FROM s0 JOIN y USING (form_id, j) LEFT JOIN d USING (form_id, j)){_MERGED[len(_SPANS):]},
jn AS (SELECT *, lag(x) OVER wl AS lx, lag(near) OVER wl AS ln, lag(place) OVER wl AS li FROM m WINDOW wl AS (PARTITION BY form_id, j ORDER BY i)),
jp AS (SELECT jn.*, j % 2 = 1 AND CASE WHEN lx LIKE '%.' THEN regexp_matches(x, '^\d') ELSE regexp_matches(x, '^[\p{{L}}\p{{N}}]') AND regexp_matches(lx, '[\p{{L}}\p{{N}}''’]$') END
  AND place * 10.0 - (li * 10.0 + CASE WHEN ln THEN 9.5 ELSE 8.0 END) <= 0.8 AS jp FROM jn),
lb AS (SELECT jp.*, coalesce(protected, false) AS protected, trim(regexp_replace(regexp_replace(trim(jp.x), '^[()\[\]]+', ''), '[()\[\]]+$', '')) AS code FROM jp LEFT JOIN (SELECT form_id, j, i, protected FROM pr) USING (form_id, j, i)),
ev AS (SELECT form_id, j, i, coalesce(jp, false) AS jp, style, x, CASE WHEN trim(x) = '' THEN 'run' WHEN style = 'italic' AND NOT protected AND code IN ({_KNOWN_SQL}) THEN 'label' WHEN style = 'bold' AND regexp_full_match(trim(x), '[0-9]+') THEN 'sense'
  WHEN style = 'symbol' THEN 'arrow' ELSE 'run' END AS kind, code FROM lb WHERE x <> ''),
ef AS (SELECT *, row_number() OVER (PARTITION BY form_id, j ORDER BY i) = 1 AS f, lag(kind || style) OVER (PARTITION BY form_id ORDER BY j, i) AS pk FROM ev),
tl AS (SELECT DISTINCT s0.form_id, s0.j + 1 AS j, open OR coalesce(act IN ('r', 'p'), false) AS tight FROM s0 LEFT JOIN d USING (form_id, j)),
eb AS (SELECT ef.form_id, ef.j, i, kind, CASE WHEN kind = 'run' THEN style END AS style, CASE kind WHEN 'label' THEN code WHEN 'sense' THEN trim(x) WHEN 'arrow' THEN '→' ELSE x END AS value,
  CASE WHEN jp AND NOT (kind = 'run' AND coalesce(pk = 'run' || style, false)) THEN '+' WHEN f AND ef.j > 0 AND NOT coalesce(tight, false) THEN '_' ELSE '' END AS b FROM ef LEFT JOIN tl USING (form_id, j))"""


@query(rf"""WITH RECURSIVE {_EVENTS}
SELECT form_id, count(*) AS n_events, count(*) FILTER (kind = 'label') AS n_labels, count(*) FILTER (kind = 'sense') AS n_senses, count(*) FILTER (b = '+') AS n_joined,
  sha256(string_agg(b || kind || ':' || coalesce(style, '') || ':' || value, chr(10) ORDER BY j, i)) AS digest FROM eb GROUP BY form_id""")
def content_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered events of each form, with boundaries from the line before, wraps and reviewed joins."""
    lines, parts = line_table(spark, sf_dir)
    odd = lines.filter("line_ord % 2 = 1").select(_line_id().alias("line_id"))
    known = F.array(*[F.lit(k) for k in KNOWN])
    events = ev.content_events(span_table(lines), known, _decisions(lines), odd, parts=parts)
    sign = F.when(F.col("boundary") == ev.JOINED, "+").when(F.col("boundary") == " ", "_").otherwise("")
    text = F.concat(sign, "kind", F.lit(":"), F.coalesce("style", F.lit("")), F.lit(":"), "value")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", text.alias("x")))), lambda e: e["x"])
    kind = lambda k: F.count_if(F.col("kind") == k)
    return events.groupBy("form_id").agg(
        F.count("*").alias("n_events"), kind("label").alias("n_labels"), kind("sense").alias("n_senses"), F.count_if(F.col("boundary") == ev.JOINED).alias("n_joined"), F.sha2(F.array_join(listed, "\n"), 256).alias("digest")
    )
