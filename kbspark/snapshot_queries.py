"""Queries on snapshots and the SQL they are held against."""

from __future__ import annotations

from kbspark.operators.snapshots import change_counts, snapshot_changes
from kbspark.sources.tables import table


def _changes(spark, folder):
    return snapshot_changes(table(spark, folder, "raw_manifest"), table(spark, folder, "snapshots"))


#: White space of any kind in DuckDB's patterns.
SPACE = r"[\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


_CHANGES = f"""
WITH scans AS (
  SELECT snapshot_id, row_number() OVER (ORDER BY observed_at, snapshot_id) AS k
  FROM snapshots WHERE lower(scan_status) = 'complete'
), readings AS (
  SELECT k, upper({strip_sql('source_id')}) AS source_id, loaded_at,
         nullif(regexp_replace(lower({strip_sql('source_hash')}), '^sha-?(256|512|1)\\s*:\\s*', ''), '') AS h,
         {strip_sql('update_time')} AS u
  FROM raw_manifest JOIN scans USING (snapshot_id)
), parsed AS (
  SELECT k, source_id, loaded_at, h,
         CASE WHEN regexp_full_match(u, '[0-9]+') THEN
                CASE WHEN try_cast(u AS BIGINT) > 10000000000 THEN try_cast(u AS BIGINT) * 1000 ELSE try_cast(u AS BIGINT) * 1000000 END
              ELSE epoch_us(try_cast(CASE WHEN regexp_matches(u, '([zZ]|[+-][0-9]{{2}}:[0-9]{{2}})$') THEN u ELSE u || 'Z' END AS TIMESTAMPTZ)) END AS t
  FROM readings WHERE source_id <> ''
), cur AS (
  SELECT * FROM parsed
  QUALIFY row_number() OVER (PARTITION BY k, source_id ORDER BY loaded_at DESC NULLS LAST, h DESC NULLS LAST, t DESC NULLS LAST) = 1
), pairs AS (
  SELECT coalesce(n.k, o.k + 1) AS k, coalesce(n.source_id, o.source_id) AS source_id,
         CASE WHEN o.source_id IS NULL THEN 'added' WHEN n.source_id IS NULL THEN 'removed'
              WHEN n.h IS NOT NULL AND o.h IS NOT NULL THEN CASE WHEN n.h <> o.h THEN 'changed' END
              WHEN n.t IS DISTINCT FROM o.t THEN 'changed' END AS change_type
  FROM cur n FULL OUTER JOIN cur o ON n.source_id = o.source_id AND n.k = o.k + 1
)
SELECT s.snapshot_id, p.source_id, p.change_type
FROM pairs p JOIN scans s USING (k) WHERE p.k > 1 AND p.change_type IS NOT NULL
"""

QUERIES = {
    "p4_found": _changes,
    "p4_counts": lambda spark, folder: change_counts(_changes(spark, folder)),
}
ORACLES = {
    "p4_found": _CHANGES,
    "p4_counts": f"SELECT snapshot_id, change_type, count(*) AS records FROM ({_CHANGES}) GROUP BY ALL",
}
