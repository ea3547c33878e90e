"""The quality rules in DuckDB SQL: an independent formulation for comparison."""

from __future__ import annotations

from rivulet.llm.quality_rules import RULES

ALPHA, DELTA = 0.02, 0.05


def _grid() -> str:
    rows = [f"('{rule}', {i}, {c}::DOUBLE)" for rule, cuts in RULES.items() for i, c in enumerate(cuts, 1)]
    return f"(VALUES {', '.join(rows)}) AS grid(rule, level, cutoff)"


ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
          FROM docs),
grams AS (SELECT r, i, w[i:i + 4] AS g
          FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM words)),
again AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
            FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r),
m AS (SELECT words.r, doc_id, lang, len(w) AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
             len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper
      FROM words LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
shares AS (
  SELECT r, 'symbol_share' AS rule, CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS x FROM f
  UNION ALL SELECT r, 'dup_line_share', CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END FROM f
  UNION ALL SELECT r, 'repeat_share', CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END FROM f
  UNION ALL SELECT r, 'mean_word', CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END FROM f
  UNION ALL SELECT r, 'upper_share', CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0 END FROM f),
held AS (SELECT r, coalesce(lang, chr(0)) AS s, quality = 1 AS good
         FROM f JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND NOT base_failed),
strata AS (SELECT s, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad FROM held GROUP BY s),
steps AS (
  SELECT s, rule, level, cutoff, n_good, n_bad,
         count(*) FILTER (good AND x > cutoff) AS k_good, count(*) FILTER (NOT good AND x > cutoff) AS k_bad
  FROM held JOIN strata USING (s) JOIN shares USING (r) JOIN {_grid()} USING (rule) GROUP BY ALL),
tested AS (
  SELECT *, list_sum(list_transform(range(0, k_good + 1), lambda j: exp(
           lgamma(n_good + 1) - lgamma(j + 1) - lgamma(n_good - j + 1)
           + j * ln({ALPHA / len(RULES)}) + (n_good - j) * ln(1 - {ALPHA / len(RULES)}))))
         <= {DELTA} / ((SELECT count(*) FROM strata) * {len(RULES)}) AS ok
  FROM steps),
certified AS (
  SELECT *, bool_and(ok) OVER (PARTITION BY s, rule ORDER BY level) AS sure,
         k_bad / greatest(n_bad, 1) - k_good / greatest(n_good, 1) AS gain
  FROM tested),
chosen AS (SELECT s, rule, cutoff FROM certified WHERE sure AND k_bad > 0
           QUALIFY row_number() OVER (PARTITION BY s, rule ORDER BY gain DESC, level) = 1),
failed AS (SELECT f.r, string_agg(shares.rule, ',' ORDER BY list_position({list(RULES)}, shares.rule)) AS rules
           FROM f JOIN shares USING (r) JOIN chosen ON chosen.rule = shares.rule AND chosen.s = coalesce(lang, chr(0))
           WHERE x > cutoff GROUP BY f.r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed.rules IS NULL AS kept, coalesce(failed.rules, '') AS failed_rules
FROM f LEFT JOIN failed USING (r)
"""
