"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from .quality import RULES, STOP_WORDS

_SPACE = r"[\x20\x09-\x0D]+"


def _quality() -> str:
    forms = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    stop = ", ".join(f"'{w}'" for w in forms)
    tests = []
    for r in RULES:
        if r.low is not None:
            tests.append(f"{r.feature} < {r.low}")
        if r.high is not None:
            tests.append(f"{r.feature} > {r.high}")
    return rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w FROM documents),
w5 AS (SELECT doc_id, i, w[i:i+4] AS win FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM w5) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id),
ln AS (SELECT doc_id, s FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS s FROM d) WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
la AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT s) AS n_dup, count(*) FILTER (regexp_matches(s, '^[\x20\x09]*[-*•]')) AS n_bul, count(*) FILTER (regexp_matches(s, '(\.\.\.|…)[\x20\x09\r]*$')) AS n_ell FROM ln GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop,
  len(regexp_extract_all(t, '\p{{Lu}}{{2,}}')) AS n_upper, len(regexp_extract_all(t, '!!')) AS n_bang, coalesce(n_lines, 0) AS n_lines, coalesce(n_bul, 0) AS n_bul, coalesce(n_ell, 0) AS n_ell
  FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN la USING (doc_id)),
r AS (SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio, n_stop / greatest(n_words, 1) AS stop_ratio, n_upper / greatest(n_words, 1) AS upper_ratio,
  n_bang / greatest(n_words, 1) AS bang_ratio, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio, n_bul / greatest(n_lines, 1) AS bullet_line_ratio, n_ell / greatest(n_lines, 1) AS ellipsis_line_ratio,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT ({" OR ".join(tests)}) AS kept FROM r"""


_SUFFIX = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS g FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 50)) AS i FROM d WHERE length(h) >= 100)),
m AS (SELECT g, min(doc_id) AS first FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, i FROM w JOIN m USING (g) WHERE first < doc_id),
isl AS (SELECT doc_id, i, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS n FROM hit)),
sp AS (SELECT doc_id, min(i) AS s, max(i) + 50 AS e FROM isl GROUP BY doc_id, k),
gap AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS p FROM sp),
agg AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last FROM sp GROUP BY doc_id),
head AS (SELECT gap.doc_id, string_agg(substr(h, 2 * p + 1, 2 * (s - p)), '' ORDER BY s) AS k FROM gap JOIN d USING (doc_id) GROUP BY gap.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(from_hex(CASE WHEN last IS NULL THEN h ELSE k || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN agg USING (doc_id) LEFT JOIN head USING (doc_id)"""

_JACCARD = r"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.y FROM r JOIN e ON e.x = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id)"""

_LEAKS = r"""WITH norm AS (SELECT 0 AS t, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT t, id, list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\x20\x09-\x0D]+', '', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM norm),
bi AS (SELECT DISTINCT id, w, len(w) AS n, least(len(w), 5) AS k FROM w WHERE t = 1 AND len(w) > 0),
ks AS (SELECT DISTINCT k FROM bi),
b AS (SELECT id AS item_id, w AS bw, n, k, i - 1 AS off, array_to_string(w[i:i+k-1], ' ') AS g FROM (SELECT *, unnest(generate_series(1, n - k + 1)) AS i FROM bi)),
s AS (SELECT id, w, k, i - 1 AS i, array_to_string(w[i:i+k-1], ' ') AS g FROM (SELECT id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, ks WHERE t = 0 AND len(w) >= k)),
hit AS (SELECT s.id AS doc_id, item_id, s.i, off, n, k, s.w, bw, greatest(len(s.w) - n, 0) AS top FROM s JOIN b USING (k, g)),
win AS (SELECT DISTINCT doc_id, item_id, start, n, k, w, bw FROM (SELECT *, unnest(generate_series(greatest(i - n + k, 0), i)) AS start FROM hit) WHERE start <= top
  UNION SELECT doc_id, item_id, i - off, n, k, w, bw FROM hit WHERE i - off > top),
x AS (SELECT doc_id, item_id, start, n, k, w[start+1:start+n] AS x, bw FROM win),
a AS (SELECT doc_id, item_id, start, n, bw, g, count(*) AS c FROM (SELECT doc_id, item_id, start, n, bw, array_to_string(x[j:j+k-1], ' ') AS g FROM (SELECT *, unnest(generate_series(1, greatest(len(x) - k + 1, 1))) AS j FROM x)) GROUP BY ALL),
an AS (SELECT doc_id, item_id, start, n, bw, sum(c) AS tot FROM a GROUP BY ALL),
it AS (SELECT item_id, bw, g, count(*) AS c FROM b GROUP BY ALL), itn AS (SELECT item_id, bw, sum(c) AS tot FROM it GROUP BY ALL),
p AS (SELECT doc_id, item_id, start, n, bw, sum(least(a.c, it.c)) AS lo FROM a JOIN it USING (item_id, bw, g) GROUP BY ALL),
q AS (SELECT doc_id, item_id, start, n, lo / (an.tot + itn.tot - lo) AS sim FROM p JOIN an USING (doc_id, item_id, start, n, bw) JOIN itn USING (item_id, bw))
SELECT doc_id, item_id, CAST(arg_max(start, (sim, -start)) AS BIGINT) AS start, CAST(arg_max(n, (sim, -start)) AS BIGINT) AS n_words, round(max(sim), 6) AS similarity FROM q WHERE sim >= 0.8 GROUP BY doc_id, item_id"""


_PHRASES = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
i AS (SELECT lang, array_to_string(w[b:b+m-1], ' ') AS phrase, max(a) AS most FROM (SELECT lang, w, a, m, unnest(generate_series(1, k - m + 1)) AS b FROM c, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k) GROUP BY ALL),
o AS (SELECT c.* FROM c LEFT JOIN i USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a),
s AS (SELECT o.lang, o.phrase, o.a, x.a AS l, y.a AS r, n, j, (1000::HUGEINT * o.a * n) // (x.a::HUGEINT * y.a) AS score FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM o) o
  JOIN t USING (lang) JOIN f x ON x.lang = o.lang AND x.phrase = array_to_string(o.w[1:j], ' ') JOIN f y ON y.lang = o.lang AND y.phrase = array_to_string(o.w[j+1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b) WHERE rank <= 2000"""

_WINDOWS = r"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
v AS (SELECT doc_id, i, md5(array_to_string(w[i:i+12], ' ')) AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT g, min(doc_id) AS first FROM v GROUP BY g HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM v JOIN m USING (g), (SELECT unnest(range(13)) AS k) WHERE first < doc_id),
t AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT t.doc_id, count(c.i) AS n_removed, string_agg(x, ' ' ORDER BY t.i) FILTER (c.i IS NULL) AS kept FROM t LEFT JOIN c ON c.doc_id = t.doc_id AND c.i = t.i GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

#: Costs are 18 digits before the audit, so that strings compare as (cost, audit); crc32 is computed bit by bit.
_REPAIR = r"""WITH RECURSIVE h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
c AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(range(0, length(k) + 1), lambda i: CASE WHEN i = 0 THEN 4294967295 ELSE CAST(ascii(substr(k, i, 1)) AS BIGINT) END),
  lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, z: xor(b >> 1, (b & 1) * 3988292384))), 4294967295) % 20 AS h FROM h),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(0, CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS again FROM c WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i FROM d),
f AS (SELECT *, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS rep, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut FROM o),
g AS (SELECT conv_id, i, role, text, turn, r, p, blank OR rep AS dead, blank, rep AND NOT blank AS dup, cut AND NOT blank AND NOT rep AS cut FROM f),
s(conv_id, i, e, s, u, a) AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT), lpad('0', 18, '0'), '9', '9', '9' FROM g
  UNION ALL SELECT conv_id, i, de, least(ds, ks), least(du, ku, ru), least(da, ka, ra) FROM (
    SELECT conv_id, i, COST(e, 4, 'D0') AS de, COST(s, 4, 'D1') AS ds, COST(u, 4, 'D2') AS du, COST(a, 4, 'D3') AS da,
      CASE WHEN NOT dead AND r = 's' THEN COST(e, x, 'K1') ELSE '9' END AS ks, CASE WHEN NOT dead AND r = 'u' THEN COST(least(e, s, a), x, 'K2') ELSE '9' END AS ku,
      CASE WHEN NOT dead THEN COST(least(e, s, a), x + 3, 'R2') ELSE '9' END AS ru, CASE WHEN NOT dead AND r = 'a' THEN COST(u, x, 'K3') ELSE '9' END AS ka, CASE WHEN NOT dead THEN COST(u, x + 3, 'R3') ELSE '9' END AS ra
    FROM (SELECT conv_id, i, r, dead, x, e, s, u, least(a, COST(u, 3, 'I')) AS a FROM (
      SELECT s.conv_id, g.i, g.r, g.dead, CASE WHEN g.cut THEN 3 ELSE 0 END AS x, e, s, a, least(u, COST(e, 3, 'I'), COST(s, 3, 'I'), COST(a, 3, 'I')) AS u
      FROM s JOIN g ON g.conv_id = s.conv_id AND g.i = s.i + 1)))),
z AS (SELECT conv_id, least(e, COST(u, 3, 'I'), COST(e, 6, 'II'), COST(s, 6, 'II'), a) AS best FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS n FROM s) WHERE i = n),
w AS (SELECT conv_id, CAST(left(best, 18) AS BIGINT) AS cost, substr(best, 19) AS marked FROM z),
t AS (SELECT conv_id, unnest(regexp_extract_all(marked, '[DIKR]*[0-3]')) AS m, generate_subscripts(regexp_extract_all(marked, '[DIKR]*[0-3]'), 1) AS i FROM w),
v AS (SELECT conv_id, i, m, CASE WHEN i = 1 THEN '0' ELSE right(lag(m) OVER (PARTITION BY conv_id ORDER BY i), 1) END AS b FROM t),
l AS (SELECT conv_id, i, CASE WHEN m LIKE 'II%' THEN CASE WHEN b = '2' THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END WHEN m LIKE 'I%' THEN CASE WHEN b = '2' THEN ['assistant:'] ELSE ['user:'] END ELSE [] END
    || CASE WHEN m LIKE '%K_' THEN [role || ':' || text] WHEN m LIKE '%R2' THEN ['user:' || text] WHEN m LIKE '%R3' THEN ['assistant:' || text] ELSE [] END AS lines FROM v JOIN g USING (conv_id, i)
  UNION ALL SELECT conv_id, 1000000000, CASE WHEN marked LIKE '%II' THEN ['user:', 'assistant:'] WHEN marked LIKE '%I' THEN ['assistant:'] ELSE [] END FROM w),
b AS (SELECT conv_id, array_to_string(flatten(list(lines ORDER BY i)), chr(10)) AS body FROM l GROUP BY conv_id),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
  count(*) FILTER (p IS NOT NULL AND p || r NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id)
SELECT q.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(regexp_replace(marked, '[0-3]', '', 'g'), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN n USING (conv_id) LEFT JOIN w USING (conv_id) LEFT JOIN b USING (conv_id)"""


def _repair() -> str:
    """COST(x, n, t) stands for: ``n`` more on the cost before the string ``x``, ``t`` after it; '9' is never."""
    cost = re.compile(r"COST\(((?:[^(),]|\([^()]*\))+), ([^,]+), ('[^']*')\)")
    return cost.sub(lambda m: f"(CASE WHEN {m[1]} = '9' THEN '9' ELSE lpad(CAST(CAST(left({m[1]}, 18) AS BIGINT) + {m[2]} AS VARCHAR), 18, '0') || substr({m[1]}, 19) || {m[3]} END)", _REPAIR)


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": _quality(), "op6_suffix_dedup": _SUFFIX, "op7_jaccard_join": _JACCARD, "op8_decontamination": _LEAKS, "op11_collocations": _PHRASES, "op12_substring_dedup": _WINDOWS, "op13_conversation_repair": _repair()}
