"""The SQL that DuckDB runs next to those operators that SQL can express on whole tables."""

from __future__ import annotations

LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every phrase of one to three words is spelled out and counted by itself.
PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({LOWER.format(text="coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, k AS length, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM split, (SELECT unnest([1, 2, 3]) AS k))),
counts AS (SELECT lang, length, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE length = 1 GROUP BY ALL),
candidates AS (SELECT lang, length, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE length > 1 AND f >= 10),
cuts AS (
  SELECT c.*, k, array_to_string(ws[1 : k], ' ') AS lp, array_to_string(ws[k + 1 : length], ' ') AS rp
  FROM (SELECT *, unnest(range(1, length)) AS k FROM candidates) c),
scores AS (
  SELECT c.lang, c.length, c.phrase, c.a, c.k, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f * r.f) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.lp JOIN counts r ON r.lang = c.lang AND r.phrase = c.rp),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT s.* FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates c
    WHERE c.lang = s.lang AND c.length > s.length AND 100 * c.a >= 50 * s.a
      AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

ORACLES: dict[str, str] = {"op11_phrase_collocations": PHRASES}
