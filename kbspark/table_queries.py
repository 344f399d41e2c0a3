"""Queries on the tables as they are delivered, on texts and on streams, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from kbspark.functions import markup
from kbspark.operators import quality
from kbspark.snapshot_queries import strip_sql
from kbspark.sources import files
from kbspark.sources.tables import table
from kbspark.streaming import readings

_TOPIC = "复核|archive"
_ID = lambda c: f"nullif(upper({strip_sql(c)}), '')"
_HASH = f"nullif(regexp_replace(lower({strip_sql('source_hash')}), '^sha-?(256|512|1)\\s*:\\s*', ''), '')"


def _headings(spark, folder):
    rows = table(spark, folder, "semantic_output").select("source_id", F.posexplode(markup.headings(F.col("content"))).alias("n", "h")).distinct()
    return rows.select("source_id", "n", F.length(F.regexp_extract("h", "^(#+)", 1)).alias("level"), F.trim(F.regexp_replace("h", "^#+[ \\t]+", "")).alias("title"))


def _unsafe(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", F.explode(markup.unsafe_characters(F.col("text"))).alias("c"))
    return rows.groupBy(F.hex(F.encode("c", "UTF-8")).alias("character")).agg(F.count(F.lit(1)).alias("times"), F.count_distinct("doc_id").alias("documents"))


def _safe(spark, folder):
    return table(spark, folder, "documents").where(F.col("text").isNotNull()).select("doc_id", F.sha2(markup.safe_characters(F.col("text")), 256).alias("text_hash"))


def _windows(spark, folder):
    w = markup.hit_windows(F.col("text"), _TOPIC, 20, 40)
    return table(spark, folder, "documents").select("doc_id", F.explode(w).alias("w")).select("doc_id", "w.start_pos", "w.end_pos")


def _tables(spark, folder, *names):
    return [table(spark, folder, n) for n in names]


QUERIES = {
    "table_checks": lambda s, d: quality.table_checks(*_tables(s, d, "raw_manifest", "snapshots", "semantic_output", "relation_verification")),
    "dangling_ends": lambda s, d: quality.dangling_ends(*_tables(s, d, "relation_verification", "raw_manifest")),
    "verdict_history": lambda s, d: quality.verdict_history(table(s, d, "relation_verification")),
    "rule_counts": lambda s, d: quality.rule_counts(table(s, d, "relation_verification")),
    "creator_names": lambda s, d: quality.creator_names(table(s, d, "raw_manifest")),
    "parse_report": lambda s, d: quality.parse_report(table(s, d, "raw_manifest")),
    "headings": _headings,
    "unsafe_characters": _unsafe,
    "safe_texts": _safe,
    "hit_windows": _windows,
    "visible_text": lambda s, d: table(s, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.sha2(markup.visible_text(F.col("text")), 256).alias("text_hash")),
    "csv_round_trip": lambda s, d: files.round_trip(table(s, d, "semantic_output").select("source_id", "document_key", "file_name", "content", "summary"), "csv"),
    "jsonl_round_trip": lambda s, d: files.round_trip(table(s, d, "relation_verification").select("relation_id", "source_id", "target_id", "verified_relation_type", "confidence"), "jsonl"),
    "streamed_readings": lambda s, d: readings.drained(readings.latest_readings(readings.files(s, d, "raw_manifest")), "readings", "source_id"),
    "streamed_event_windows": lambda s, d: readings.drained(readings.windowed_events(readings.files(s, d, "events")), "windows", "window_start", "event_type"),
}

_UNSAFE = "[\\x00-\\x08\\x0B-\\x1F\\x7F-\\x9F\\p{Cf}\\p{Co}]"
_CHECKS = [
    ("raw_manifest", "manifest id given", f"{_ID('source_id')} IS NOT NULL"),
    ("raw_manifest", "manifest id canonical", "regexp_full_match(source_id, 'KB-[0-9A-F]{12}')"),
    ("raw_manifest", "manifest hash is sha256", f"regexp_full_match({_HASH}, '[0-9a-f]{{64}}')"),
    ("raw_manifest", "manifest extension plain", f"extension = regexp_replace(lower({strip_sql('extension')}), '^\\.+', '')"),
    ("raw_manifest", "manifest creator given", f"{strip_sql('creator_uid')} <> ''"),
    ("raw_manifest", "manifest length given", "extracted_chars > 0"),
    ("raw_manifest", "manifest scan known", "snapshot_id IN (SELECT snapshot_id FROM snapshots)"),
    ("semantic_output", "content given", f"{strip_sql('content')} <> ''"),
    ("semantic_output", "summary given", f"{strip_sql('summary')} <> ''"),
    ("semantic_output", "content key fits", "sha256(coalesce(content, '')) = document_key"),
    ("relation_verification", "verdict ends given", f"{_ID('source_id')} IS NOT NULL AND {_ID('target_id')} IS NOT NULL"),
    ("relation_verification", "verdict ends differ", f"{_ID('source_id')} <> {_ID('target_id')}"),
    ("relation_verification", "verdict confidence in range", "confidence BETWEEN 0 AND 1"),
    ("relation_verification", "verdict type given", f"{strip_sql('verified_relation_type')} <> ''"),
]
_VISIBLE = "regexp_replace(regexp_replace(regexp_replace(text, '(?is)<(script|style|noscript|svg|template|canvas)\\b.*?</(script|style|noscript|svg|template|canvas)\\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)</?[A-Za-z][^<>]*>', chr(10), 'g')"
for _a, _b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _VISIBLE = f"replace({_VISIBLE}, '{_a}', '{_b}')"

ORACLES = {
    "table_checks": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows, count(*) FILTER (NOT coalesce({rule}, false)) AS failed FROM {t}" for t, n, rule in _CHECKS),
    "dangling_ends": f"WITH e AS (SELECT {_ID('source_id')} AS source_id FROM relation_verification UNION ALL SELECT {_ID('target_id')} FROM relation_verification) SELECT source_id, count(*) AS verdicts FROM e WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT {_ID('source_id')} FROM raw_manifest WHERE {_ID('source_id')} IS NOT NULL) GROUP BY 1",
    "verdict_history": f"WITH r AS (SELECT DISTINCT relation_id, verified_at, lower({strip_sql('verification_status')}) AS s FROM relation_verification WHERE {strip_sql('relation_id')} <> ''), o AS (SELECT *, row_number() OVER (PARTITION BY relation_id ORDER BY verified_at NULLS FIRST, s NULLS FIRST) AS k, count(*) OVER (PARTITION BY relation_id) AS n FROM r) SELECT relation_id, max(n) AS verdicts, max(s) FILTER (k = 1) AS first_status, max(s) FILTER (k = n) AS last_status, max(s) FILTER (k = 1) IS DISTINCT FROM max(s) FILTER (k = n) AS changed FROM o GROUP BY 1",
    "rule_counts": f"SELECT rule, status, count(*) AS relations FROM (SELECT DISTINCT relation_id, lower({strip_sql('verification_status')}) AS status, unnest(string_split(rule_ids, '/')) AS rule FROM relation_verification) GROUP BY ALL",
    "creator_names": f"WITH r AS (SELECT nullif({strip_sql('creator_uid')}, '') AS creator_uid, nullif({strip_sql('creator_name')}, '') AS n, loaded_at FROM raw_manifest) SELECT creator_uid, first(n ORDER BY loaded_at DESC NULLS LAST, n DESC) FILTER (n IS NOT NULL) AS creator_name, count(DISTINCT n) AS spellings FROM r WHERE creator_uid IS NOT NULL GROUP BY 1",
    "parse_report": "SELECT snapshot_id, count(*) AS rows, count(*) FILTER (trim(parse_status) = '全文已解析') AS parsed, count(*) FILTER (trim(parse_status) = '失败已登记') AS failed, count(*) FILTER (trim(parse_status) = '待解析') AS pending, count(*) FILTER (NOT coalesce(trim(parse_status) IN ('全文已解析', '失败已登记', '待解析'), false)) AS other FROM raw_manifest GROUP BY 1",
    "headings": "WITH h AS (SELECT DISTINCT source_id, i - 1 AS n, l[i] AS h FROM (SELECT source_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT source_id, regexp_extract_all(content, '(?:^|[\\r\\n])(#{1,6}[ \\t]+[^\\r\\n]+)', 1) AS l FROM semantic_output))) SELECT source_id, CAST(n AS INT) AS n, CAST(length(regexp_extract(h, '^(#+)', 1)) AS INT) AS level, trim(regexp_replace(h, '^#+[ \\t]+', '')) AS title FROM h",
    "unsafe_characters": f"SELECT hex(c) AS character, count(*) AS times, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, unnest(regexp_extract_all(text, '({_UNSAFE})', 1)) AS c FROM documents) GROUP BY 1",
    "safe_texts": f"SELECT doc_id, sha256(regexp_replace(text, '{_UNSAFE}', '', 'g')) AS text_hash FROM documents WHERE text IS NOT NULL",
    "hit_windows": f"""WITH g AS (SELECT doc_id, length(text) AS total, regexp_split_to_array(text, '{_TOPIC}') AS gaps, regexp_extract_all(text, '{_TOPIC}') AS hits FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, total, i, length(gaps[i]) AS gap, length(hits[i]) AS hit FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM g)),
w AS (SELECT doc_id, i, greatest(sum(gap + hit) OVER o - hit - 20, 0) AS a, least(sum(gap + hit) OVER o + 40, total) AS b FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM w),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM m)
SELECT doc_id, CAST(min(a) AS INT) AS start_pos, CAST(max(b) AS INT) AS end_pos FROM k GROUP BY doc_id, island""",
    "visible_text": f"SELECT doc_id, sha256(trim(regexp_replace({_VISIBLE}, '[ \\t]*\\n\\s*', chr(10), 'g'), ' ')) AS text_hash FROM documents WHERE text IS NOT NULL",
    "csv_round_trip": "SELECT source_id, document_key, file_name, content, summary FROM semantic_output",
    "jsonl_round_trip": "SELECT relation_id, source_id, target_id, verified_relation_type, confidence FROM relation_verification",
    "streamed_readings": f"WITH r AS (SELECT {_ID('source_id')} AS source_id, loaded_at, {_HASH} AS source_hash FROM raw_manifest) SELECT source_id, loaded_at, source_hash, readings FROM (SELECT *, count(*) OVER (PARTITION BY source_id) AS readings FROM r WHERE source_id IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY loaded_at DESC NULLS LAST, source_hash DESC NULLS LAST) = 1",
    "streamed_event_windows": "SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL",
}
