"""p3: records whose texts differ by small edits."""

from __future__ import annotations

from kbspark.llm.neardup import duplicate_groups, similar_records
from kbspark.snapshot_queries import strip_sql
from kbspark.sources.tables import table

QUERIES = {
    "p3_found": lambda spark, folder: similar_records(table(spark, folder, "semantic_output")),
    "p3_groups": lambda spark, folder: duplicate_groups(table(spark, folder, "semantic_output")),
}
ORACLES = {
    "p3_found": f"""
WITH t AS (
  SELECT DISTINCT upper({strip_sql('source_id')}) AS id, regexp_replace(lower(CASE WHEN {strip_sql('content')} <> '' THEN content ELSE summary END), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS x
  FROM semantic_output
), long AS (SELECT id, x, row_number() OVER () AS k FROM t WHERE id <> '' AND length(x) >= 100),
g AS (SELECT DISTINCT k, hash(substr(x, i, 5)) AS g FROM (SELECT k, x, unnest(range(1, length(x) - 3)) AS i FROM long)),
n AS (SELECT k, count(*) AS n FROM g GROUP BY 1),
met AS (SELECT a.k AS ka, b.k AS kb, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.k < b.k GROUP BY ALL)
SELECT DISTINCT least(la.id, lb.id) AS id_a, greatest(la.id, lb.id) AS id_b
FROM met JOIN n na ON na.k = ka JOIN n nb ON nb.k = kb JOIN long la ON la.k = ka JOIN long lb ON lb.k = kb
WHERE la.id <> lb.id AND c >= 0.7 * (na.n + nb.n - c) - 1e-9
""",
}
