"""SQL for DuckDB that the operators SQL can express must agree with.

The other ones (language, quality, passages, SimHash, packing, alignment, whitening,
token files, the pipeline) are tested
against brute-force versions, held-out accuracy and exact round trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from changefeed.llm.licenses import NOTICES, STRIDE, WINDOW

_TOKENS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

_MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({_TOKENS}) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9) AS h FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
-- Sources in order of how soon they reach their bound.
filled AS (
  SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
              ORDER BY source_size / w, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_words,
            sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
  FROM totals),
stopping AS (SELECT *, 3 * source_size / w <= left_words / left_weight AS stops FROM filled),
level AS (
  SELECT arg_min(left_words, source_size / w) AS words, arg_min(left_weight, source_size / w) AS weights
  FROM stopping WHERE NOT stops),
targets AS (
  SELECT source, source_size,
         CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE) ELSE w * words / weights END AS target
  FROM stopping LEFT JOIN level ON true),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS times FROM targets),
hashes AS (
  SELECT source, h, sum(size) AS inside FROM sized GROUP BY source, h),
summed AS (
  SELECT *, sum(inside) OVER (PARTITION BY source ORDER BY h) AS upto FROM hashes),
edges AS (
  SELECT b.*, coalesce(min(h) FILTER (WHERE upto > target - times * source_size), max(h)) AS edge
  FROM budget b JOIN summed s ON b.source IS NOT DISTINCT FROM s.source GROUP BY ALL)
SELECT doc_id, size, source_size, target,
       CAST(times * size + CASE WHEN d.h < edge THEN size WHEN d.h = edge AND s.inside > 0
         THEN floor(size * (target - times * source_size - (s.upto - s.inside)) / s.inside)
         ELSE 0 END AS BIGINT) AS taken
FROM sized d
JOIN edges e ON d.source IS NOT DISTINCT FROM e.source
JOIN summed s ON s.source IS NOT DISTINCT FROM e.source AND s.h = e.edge
"""

_TOP = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id,
       CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id)
         AS INTEGER) AS rank,
       c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) <= 5
"""

_VECTORS = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS one, b.vec_id AS other FROM sound a JOIN sound b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT one, other FROM links
  UNION
  SELECT reached.one, links.other FROM reached JOIN links ON links.one = reached.other)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) AS kept
FROM embeddings e
LEFT JOIN (SELECT one, count(*) AS n FROM links GROUP BY one) l ON l.one = e.vec_id
LEFT JOIN (SELECT one, min(other) AS m FROM reached GROUP BY one) r ON r.one = e.vec_id
"""


def _urls(rules: Sequence[tuple[str, str, str]]) -> str:
    listed = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in rules)
    # No page here names a canonical address or refreshes, and a fragment changes
    # neither host nor path, so an address without a rule has no alias with one.
    return f"""
WITH parts AS (
  SELECT page_id,
         coalesce(lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules AS (SELECT * FROM (VALUES {listed}) AS r(verdict, h, p)),
fits AS (
  SELECT page_id, arg_min(h || p, (-length(h || p), verdict)) AS rule,
         arg_min(verdict, (-length(h || p), verdict)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""


def _licenses() -> str:
    quoted = ", ".join(f"('{name}', '{notice}')" for name, notice in NOTICES)

    def words(text: str) -> str:
        return f"string_split(trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"

    grams = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"
    return f"""
WITH notices AS (
  SELECT license, list_distinct({grams}) AS notice
  FROM (SELECT license, {words("n")} AS w FROM (VALUES {quoted}) AS v(license, n))),
shingled AS (
  SELECT doc_id, {grams} AS g FROM (SELECT doc_id, {words("text")} AS w FROM documents) WHERE len(w) >= 5),
windows AS (
  SELECT doc_id, first, len(g) + 3 AS final, list_distinct(g[first + 1:first + {WINDOW - 4}]) AS held
  FROM (SELECT doc_id, g, unnest(range(0, len(g), {STRIDE})) AS first FROM shingled)),
found AS (
  SELECT doc_id, license, first, final, len(list_intersect(notice, held)) / len(notice) AS share
  FROM windows JOIN notices ON list_has_any(held, notice))
SELECT doc_id, license, max(share) AS containment,
       CAST(arg_max(first, (share, -first)) AS INTEGER) AS first_word,
       CAST(arg_max(least(first + {WINDOW - 1}, final), (share, -first)) AS INTEGER) AS last_word
FROM found WHERE share >= 0.8 GROUP BY doc_id, license
"""


def oracle_sql(url_rules: Sequence[tuple[str, str, str]]) -> dict[str, str]:
    return {
        "op3_mixing": _MIXING,
        "op4_url_filter": _urls(url_rules),
        "op5_license_scan": _licenses(),
        "op8_topk": _TOP,
        "op10_embedding_dedup": _VECTORS,
    }
