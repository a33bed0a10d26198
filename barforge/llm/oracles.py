"""DuckDB counterparts, written apart from the operators; run over whole tables."""

from __future__ import annotations

from barforge.llm.rules import STOP_WORDS

_STOP = ", ".join("'" + v.replace("'", "''") + "'" for v in sorted({v for line in STOP_WORDS for u in line.split() for v in (u, u.capitalize())}))

OP6 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, unnest(range(0, len(words) - 7)) AS i, words FROM d WHERE len(words) >= 8
), keyed AS (
  SELECT doc_id, i, array_to_string(words[i + 1 : i + 8], ' ') AS g FROM grams
), twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM keyed
), covered AS (
  SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM twice WHERE c > 1
), reps AS (
  SELECT doc_id, sum(n) AS n FROM covered GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(reps.n, 0)::BIGINT AS n_repeat_words,
         (length(text) - length(regexp_replace(text, '\p{{L}}+', '', 'g')))::BIGINT AS n_letters,
         (length(text) - length(regexp_replace(text, '\p{{Lu}}+', '', 'g')))::BIGINT AS n_capitals,
         len(regexp_extract_all(text, '!!'))::BIGINT AS n_shouts,
         len(list_filter(words, lambda w: w IN ({_STOP})))::BIGINT AS n_stop_words,
         len(list_filter(words, lambda w, i: i > 1 AND w = words[i - 1]))::BIGINT AS n_stutters,
         len(list_filter(lines, lambda x: x LIKE '%...' OR x LIKE '%…'))::BIGINT AS n_ellipsis_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\t]*[-*•]')))::BIGINT AS n_bullet_lines
  FROM d LEFT JOIN reps ON reps.doc_id = d.doc_id
), v AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words <= 2000000
       AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words
       AND 100 * n_symbols <= 30 * n_words
       AND (n_lines < 1 OR 100 * n_dup_lines <= 40 * n_lines)
       AND (word_chars < 1 OR 100 * n_letters >= 60 * word_chars)
       AND (n_letters < 50 OR 100 * n_capitals <= 50 * n_letters)
       AND 100 * n_shouts <= 20 * n_words
       AND (n_words < 50 OR 100 * n_stop_words >= 2 * n_words)
       AND (n_words < 20 OR 100 * n_stutters <= 25 * n_words)
       AND (n_lines < 5 OR 100 * n_ellipsis_lines <= 40 * n_lines)
       AND (n_lines < 5 OR 100 * n_bullet_lines <= 90 * n_lines) AS kept
FROM v
"""

_KINDS = (
    ("assign", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("forge", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("cloud", r"AIza[0-9A-Za-z_-]+", 0, 39),
    ("signed", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 32),
    ("login", r"://[^/\x00-\x20:@]+:[^/\x00-\x20:@]+@", 0, 8),
)


def _kind(number: int, name: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS k, '{name}' AS kind, b AS s, b + len(m[i]) AS e, len(v[i]) AS size FROM (
    SELECT doc_id, m, v, i, list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS b FROM (
      SELECT doc_id, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, '{quoted}') AS m, regexp_extract_all(text, '{quoted}', {group}) AS v,
               regexp_split_to_array(text, '{quoted}') AS g FROM d WHERE regexp_matches(text, '{quoted}'))))
  WHERE len(v[i]) >= {least}"""


OP10 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(_kind(n, *x) for n, x in enumerate(_KINDS))}),
a AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) AS spans
  FROM f GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""

OP1 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) WHEN len(w) = 1 THEN w ELSE [] END) AS g FROM d)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT doc_id, g, hash(g) AS h FROM s),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM k a JOIN k b ON a.h = b.h AND a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), sym AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, s.b FROM reach r JOIN sym s ON s.a = r.b
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = d.doc_id
"""
