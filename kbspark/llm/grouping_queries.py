"""p2: groups of records that verdicts link."""

from __future__ import annotations

from kbspark.llm.grouping import verdict_groups
from kbspark.snapshot_queries import strip_sql
from kbspark.sources.tables import table

QUERIES = {
    "p2_found": lambda spark, folder: verdict_groups(table(spark, folder, "relation_verification")),
}
ORACLES = {
    "p2_found": f"""
WITH RECURSIVE v AS (
  SELECT {strip_sql('relation_id')} AS r, upper({strip_sql('source_id')}) AS s, upper({strip_sql('target_id')}) AS t,
         lower({strip_sql('verification_status')}) AS status, {strip_sql('verified_relation_type')} AS kind, verified_at
  FROM relation_verification
), latest AS (
  SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY r ORDER BY verified_at DESC NULLS LAST, s DESC NULLS LAST, t DESC NULLS LAST) = 1
), m AS (
  SELECT s, t FROM latest WHERE status = 'confirmed' AND kind IN ('完全重复', '版本关系') AND s <> t AND s <> '' AND t <> ''
), e AS (SELECT s, t FROM m UNION SELECT t, s FROM m),
reached AS (
  SELECT s AS a, s AS b FROM e
  UNION
  SELECT r.a, e.t FROM reached r JOIN e ON r.b = e.s
)
SELECT a AS source_id, min(b) AS group_id FROM reached GROUP BY a
""",
}
