"""SQL that checks the operators which SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

NEAR_DUPLICATES = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.c + y.c - k)),
z AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT r.node, z.b FROM r JOIN z ON r.other = z.a)
SELECT d.doc_id, coalesce(c, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT node, min(other) AS component_id FROM r GROUP BY node) m ON m.node = d.doc_id"""

DECONTAMINATION = f"""WITH w AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
i AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
r AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
k AS (SELECT DISTINCT n FROM r),
g AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM w, k WHERE len(w) >= n)),
h AS (SELECT g.doc_id, g.s, g.n, r.item_id FROM g JOIN r ON g.g = r.g AND g.n = r.n),
p AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS x FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s FROM h GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(t.s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN p ON p.doc_id = w.doc_id LEFT JOIN t ON t.doc_id = w.doc_id"""

_STEPS = "[1.0, 0.9995, 0.999, 0.9985, 0.998, 0.997, 0.996, 0.995, 0.993, 0.99, 0.985, 0.98]"
_MEASURES = ("symbols", "capitals", "lines", "repeats")
_CUTS = ", ".join(f"max(c) FILTER (m = '{m}') AS {m}_cuts" for m in _MEASURES)
_LEVEL = "least(" + ", ".join(f"len(list_filter({m}_cuts, lambda c: c >= {m}))" for m in _MEASURES) + ")"
_OVER = " OR ".join(f"coalesce(f.{m} > {m}_cuts[step + 1], false)" for m in _MEASURES)

QUALITY = f"""WITH w AS (SELECT doc_id, coalesce(lang, chr(0)) AS stratum, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, t, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents)),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT x) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS x FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1) GROUP BY doc_id),
b AS (SELECT w.doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_capitals, len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
f AS (SELECT *, least(1000, 1000 * n_symbols // greatest(word_chars, 1)) AS symbols, least(1000, 1000 * n_capitals // greatest(word_chars, 1)) AS capitals, least(1000, 1000 * n_dup_lines // greatest(n_lines, 1)) AS lines, least(1000, 1000 * n_repeat_words // greatest(n_words, 1)) AS repeats FROM b),
y AS (SELECT f.*, good = 1 AS good, md5('half' || f.doc_id)[1] < '8' AS tuning FROM f JOIN (SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id) t ON t.doc_id = f.doc_id),
e AS ({' UNION ALL '.join(f"SELECT stratum, '{m}' AS m, {m} AS bin FROM y WHERE tuning AND good" for m in _MEASURES)}),
h AS (SELECT stratum, m, bin, sum(n) OVER (PARTITION BY stratum, m ORDER BY bin) AS below, sum(n) OVER (PARTITION BY stratum, m) AS total FROM (SELECT stratum, m, bin, count(*) AS n FROM e GROUP BY stratum, m, bin)),
q AS (SELECT stratum, m, i, min(bin) FILTER (below >= ({_STEPS})[i + 1]::DOUBLE * total) AS c FROM h, (SELECT unnest(range(12)) AS i) GROUP BY stratum, m, i),
a AS (SELECT stratum, m, list(c ORDER BY i) AS c FROM q GROUP BY stratum, m),
cuts AS (SELECT stratum, {_CUTS} FROM a GROUP BY stratum),
lv AS (SELECT y.stratum, tuning, good, {_LEVEL} AS level FROM y JOIN cuts ON cuts.stratum = y.stratum),
c AS (SELECT stratum, step, count(*) FILTER (NOT tuning AND good AND level <= step) AS k, count(*) FILTER (NOT tuning AND good) AS n, count(*) FILTER (tuning AND good AND level <= step) AS fp, count(*) FILTER (tuning AND good) AS p, count(*) FILTER (tuning AND NOT good AND level <= step) AS tn, count(*) FILTER (tuning AND NOT good) AS q FROM lv, (SELECT unnest(range(12)) AS step) GROUP BY stratum, step),
t AS (SELECT *, n > 0 AND CASE WHEN k >= n * 0.02::DOUBLE THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.02::DOUBLE) + (n - j) * ln(0.98::DOUBLE)))) END <= 0.05::DOUBLE / (SELECT count(*) FROM cuts) AS holds FROM c),
v AS (SELECT *, min(holds::INT) OVER (PARTITION BY stratum ORDER BY step) = 1 AS valid FROM t),
best AS (SELECT stratum, arg_max(step, (tn / greatest(q, 1) - fp / greatest(p, 1), -step)) AS step FROM v WHERE valid GROUP BY stratum)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT ({_OVER}) AS kept
FROM f LEFT JOIN cuts ON cuts.stratum = f.stratum LEFT JOIN best ON best.stratum = f.stratum"""
