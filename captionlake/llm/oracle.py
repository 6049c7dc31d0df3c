"""SQL of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_FOLD = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = f"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_FOLD.format(t="coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLD.format(t="coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
starts AS (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM bw WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, array_to_string(w[i : least(i + 9, len(w))], ' ') AS s, least(10, len(w)) AS n FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n),
hits AS (SELECT p.doc_id, p.i, p.n, v.item FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM places) p JOIN windows v ON p.n = v.n AND p.s = v.s),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN items x ON d.doc_id = x.doc_id
"""

HOST_QUALITY = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM t),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT l) AS d FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM t) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(l.n - l.d, 0) AS n_dup_lines, coalesce(l.n, 0) AS n_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeats r ON w.doc_id = r.doc_id LEFT JOIN lines l ON w.doc_id = l.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR n_symbols > 0.1::DOUBLE * n_words OR n_dup_lines > 0.3::DOUBLE * n_lines AS failed FROM b),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS f FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT sum(f) / sum(n) AS mean, var_pop(f / n) AS var FROM hosts),
s AS (SELECT mean, CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, 2.0::DOUBLE), 1000.0::DOUBLE) ELSE 1000.0::DOUBLE END AS strength FROM p),
v AS (SELECT source, (f + mean * strength) / (n + strength) > 0.8::DOUBLE AS host_failed FROM hosts, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(host_failed, false) AS kept FROM f LEFT JOIN v ON f.source = v.source
"""

ORACLES = {"op3_decontaminate": DECONTAMINATE, "op10_host_quality": HOST_QUALITY}
