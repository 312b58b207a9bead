"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from strata.llm.mixing import KEY_BITS, MAX_PASSES, WEIGHTS
from strata.llm.url_filter import LISTED_LABELS, RULES

EXACT = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_WEIGHT = "CASE place % {} {} END".format(
    len(WEIGHTS), " ".join(f"WHEN {i} THEN {weight}" for i, weight in enumerate(WEIGHTS))
)

MIX = rf"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, {KEY_BITS // 4}))::BIGINT AS key
  FROM documents
),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sizes GROUP BY source
),
limited AS (
  SELECT *, {_WEIGHT} AS weight, {MAX_PASSES} * source_size AS most,
         sum(source_size) OVER ()::BIGINT AS total
  FROM per_source
),
leveled AS (
  SELECT *, most / weight AS ratio,
         (total - coalesce(sum(most) OVER before, 0))::BIGINT
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS level
  FROM limited
  WINDOW before AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
decided AS (
  SELECT *, coalesce(bool_or(ratio > level) OVER before, false) AS decided
  FROM leveled
  WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, source_size, total,
         least(most::DOUBLE, weight * max(CASE WHEN NOT decided THEN level END) OVER ()) AS target
  FROM decided
),
flows AS (
  SELECT s.*, t.source_size, t.target, t.total,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS sent
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
turns AS (
  SELECT *, (turn * source_size + sent)::BIGINT / target AS finish
  FROM flows, range({MAX_PASSES}) AS turns(turn)
  WHERE size > 0
),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, key, doc_id, size, turn
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mixed
  FROM turns
),
taken AS (
  SELECT doc_id, key, size, source, count(*) AS passes FROM ordered WHERE mixed <= total
  GROUP BY doc_id, key, size, source
)
SELECT f.doc_id, f.size, f.source_size, f.target, (f.size * coalesce(t.passes, 0))::BIGINT AS taken
FROM flows f
LEFT JOIN taken t ON t.doc_id = f.doc_id AND t.size = f.size AND t.source IS NOT DISTINCT FROM f.source
"""

_FITS = [
    f"WHEN (host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}') "
    f"THEN '{rule.text}'"
    for rule in sorted(RULES, key=lambda rule: (-len(rule.text), -len(rule.host), rule.text))
]
_VERDICTS = [f"WHEN '{rule.text}' THEN '{rule.verdict}'" for rule in RULES]

URLS = rf"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(url, '^(?s:.*?)://[^?#]*\?([^#]*)', 1) AS query
  FROM pages
),
shortened AS (
  SELECT *,
         regexp_replace(regexp_replace(query, '(^|&)(utm_[a-z]+|ref)=[^&]*', '', 'g'), '^&+', '') AS rest
  FROM parts
),
canonical AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
         regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '')
         || regexp_replace(regexp_replace(path, '\.html$', ''), '/+$', '')
         || CASE WHEN rest != '' THEN '?' || rest ELSE '' END END AS canonical
  FROM shortened
),
listed AS (
  SELECT DISTINCT canonical AS listed_url FROM canonical
  WHERE regexp_matches(host, '(^|\.)({"|".join(LISTED_LABELS)})\.')
),
ruled AS (
  SELECT *, CASE {" ".join(_FITS)} END AS rule FROM canonical
)
SELECT page_id, host, path, rule,
       CASE rule {" ".join(_VERDICTS)} ELSE CASE WHEN listed_url IS NOT NULL THEN 'block' ELSE 'allow' END END
         AS verdict,
       rule IS NULL AND listed_url IS NOT NULL AS listed
FROM ruled LEFT JOIN listed ON canonical = listed_url
"""

NEGATIVES = """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM used a JOIN used r ON a.vec_id != r.vec_id AND len(a.v) = len(r.v)
  WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": EXACT,
        "op3_source_mix": MIX,
        "op4_url_filter": URLS,
        "op12_hard_negatives": NEGATIVES,
    }
