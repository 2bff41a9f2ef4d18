"""Queries of the training-data operators as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from altigrid.llm import preferences
from altigrid.llm.quality import CLASSES, WORDS

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 10
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.rid <> c.rid AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS nth FROM s WHERE same QUALIFY nth <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.rid, p.nth ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.rid = s.rid AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT * FROM n WHERE rank <= 10
"""

_SPACE = r"\x20\x09-\x0D"


def _sized(pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"(length(text) - length(regexp_replace(text, '{quoted}', '', 'g')))"


def _distance(of: str) -> str:
    """Per rid: Jensen-Shannon distance of its shares to the mean of its language."""
    return f"""
{of}_at AS (SELECT rid, lang, n_words, unnest(range(1, len({of}) + 1)) AS pos, unnest({of}) AS p FROM h),
{of}_ref AS (SELECT lang, pos, avg(p) AS q FROM {of}_at WHERE n_words > 0 GROUP BY lang, pos),
{of}_far AS (
  SELECT rid, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END) + (CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END)) / 2, 0)) AS far
  FROM {of}_at a JOIN {of}_ref r ON a.pos = r.pos AND a.lang IS NOT DISTINCT FROM r.lang GROUP BY rid
)"""


def quality_sql() -> str:
    sizes = ", ".join(_sized(p) for p in CLASSES.values())
    words = ", ".join(f"'{w}'" for w in WORDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^{_SPACE}]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS lines, [{sizes}] AS cs FROM d
), win AS (
  SELECT rid, i, words[i:i + 4] AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), cov AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1), range(0, 5) t(k) GROUP BY rid
), keys AS (
  SELECT rid, list_transform(words, lambda x: regexp_extract(lower(x), '^[^.,;:!?]*')) AS ks FROM w
), h AS (
  SELECT w.rid, lang, CAST(len(words) AS BIGINT) AS n_words, length(text) AS n_chars,
    list_transform(list_append(cs, length(text) - CAST(list_sum(cs) AS BIGINT)), lambda c: CAST(c AS DOUBLE) / greatest(length(text), 1)) AS chars,
    list_transform(list_append(list_transform([{words}], lambda x: len(list_filter(ks, lambda k: k = x))), len(list_filter(ks, lambda k: NOT list_contains([{words}], k)))),
      lambda c: CAST(c AS DOUBLE) / greatest(len(words), 1)) AS common
  FROM w JOIN keys USING (rid)
),{_distance("chars")},{_distance("common")},
b AS (
  SELECT w.rid, doc_id, h.n_words, CAST(length(text) - cs[2] AS BIGINT) AS word_chars, CAST(cs[6] AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    CASE WHEN h.n_chars >= 200 THEN c.far ELSE 0 END AS far_chars, CASE WHEN h.n_words >= 50 THEN m.far ELSE 0 END AS far_common
  FROM w JOIN h USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN chars_far c USING (rid) LEFT JOIN common_far m USING (rid)
), f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(far_chars, 0) <= 0.3 AND coalesce(far_common, 0) <= 0.45 AND coalesce(far_chars, 0) + coalesce(far_common, 0) <= 0.4 AS kept
FROM f
"""


def llm_oracles() -> dict[str, str]:
    return {"op4_preferences": preferences.ORACLE, "op8_exact_top_k": TOP_K, "op13_hard_negatives": HARD_NEGATIVES, "op10_quality_rules": quality_sql()}
