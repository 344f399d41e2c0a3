"""p1: oversized contents in pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from kbspark.functions.text import canonical_extension
from kbspark.llm.splitting import oversized_ids, rebuilt, split_oversized
from kbspark.snapshot_queries import strip_sql
from kbspark.sources.tables import table


def _split(spark, folder):
    return split_oversized(table(spark, folder, "semantic_output"), table(spark, folder, "split_limits"))


def _rebuilt(spark, folder):
    """Every split content put together again, and whether its pieces keep to the limit of its extension."""
    limits = table(spark, folder, "split_limits").select(canonical_extension("extension").alias("e"), "max_chars")
    rest = limits.where("e = '*'").select(F.col("max_chars").alias("rest"))
    rows = rebuilt(_split(spark, folder)).join(F.broadcast(limits.where("e <> '*'")), F.col("extension") == F.col("e"), "left").join(F.broadcast(rest), F.lit(True), "left")
    return rows.select("source_id", "extension", "text_hash", "shared", (F.col("longest") <= F.coalesce("max_chars", "rest")).alias("within"))


QUERIES = {
    "p1_found": lambda spark, folder: oversized_ids(_split(spark, folder)),
    "p1_pieces": _split,
    "p1_rebuilt": _rebuilt,
}
_EXT = "coalesce(regexp_replace(lower({0}), '^\\.+', ''), '')"
ORACLES = {
    "p1_found": f"""
WITH t AS (SELECT upper({strip_sql('source_id')}) AS source_id, {_EXT.format(strip_sql('extension'))} AS e, content FROM semantic_output),
     l AS (SELECT {_EXT.format(strip_sql('extension'))} AS e, max_chars FROM split_limits)
SELECT DISTINCT source_id
FROM t LEFT JOIN l ON t.e = l.e AND l.e <> '*'
WHERE source_id <> '' AND length(content) > coalesce(l.max_chars, (SELECT max_chars FROM l WHERE e = '*'))
""",
    "p1_rebuilt": f"""
WITH t AS (SELECT nullif(upper({strip_sql('source_id')}), '') AS source_id, {_EXT.format(strip_sql('extension'))} AS e, content FROM semantic_output),
     l AS (SELECT {_EXT.format(strip_sql('extension'))} AS e, max_chars, overlap_chars FROM split_limits)
SELECT DISTINCT source_id, t.e AS extension, sha256(content) AS text_hash, coalesce(l.overlap_chars, r.overlap_chars) AS shared, true AS within
FROM t LEFT JOIN l ON t.e = l.e AND l.e <> '*' CROSS JOIN (SELECT * FROM l WHERE e = '*') r
WHERE length(content) > coalesce(l.max_chars, r.max_chars)
""",
}
