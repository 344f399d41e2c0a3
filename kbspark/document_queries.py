"""Queries on documents, relations, folders and changes, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from kbspark.functions import titles as T
from kbspark.functions.times import instant_micros
from kbspark.operators import folders, incremental, neighbours, relations
from kbspark.operators.documents import documents, listing, readings
from kbspark.plans.lineage import cut
from kbspark.snapshot_queries import strip_sql
from kbspark.sources.tables import table

_EXT = f"coalesce(regexp_replace(lower({strip_sql('extension')}), '^\\.+', ''), '')"


def _hash_sql(c: str) -> str:
    return f"nullif(regexp_replace(lower({strip_sql(c)}), '^sha-?(256|512|1)\\s*:\\s*', ''), '')"


def micros_sql(u: str) -> str:
    return f"""CASE WHEN regexp_full_match({u}, '[0-9]+') THEN
                CASE WHEN try_cast({u} AS BIGINT) > 10000000000 THEN try_cast({u} AS BIGINT) * 1000 ELSE try_cast({u} AS BIGINT) * 1000000 END
              ELSE epoch_us(try_cast(CASE WHEN regexp_matches({u}, '([zZ]|[+-][0-9]{{2}}:[0-9]{{2}})$') THEN {u} ELSE {u} || 'Z' END AS TIMESTAMPTZ)) END"""


#: Views that the SQL of this module begins with.
_EACH = f"""
WITH RECURSIVE scans AS (
  SELECT snapshot_id, row_number() OVER (ORDER BY observed_at, snapshot_id) AS k, count(*) OVER () AS n
  FROM snapshots WHERE lower(trim(scan_status)) = 'complete'
), each AS (
  SELECT * FROM (
    SELECT s.k, s.n, m.snapshot_id, upper({strip_sql('source_id')}) AS source_id, loaded_at, file_name, source_path, node_id, parent_node_id, source_url, content_type, creator_uid,
           permission_hash, {_EXT} AS extension, {micros_sql(strip_sql('update_time'))} AS updated, {_hash_sql('source_hash')} AS source_hash, {_hash_sql('extracted_hash')} AS extracted_hash, extracted_chars
    FROM raw_manifest m JOIN scans s USING (snapshot_id))
  WHERE source_id <> ''
  QUALIFY row_number() OVER (PARTITION BY k, source_id ORDER BY loaded_at DESC NULLS LAST, file_name DESC NULLS LAST, source_path DESC NULLS LAST, node_id DESC NULLS LAST,
    parent_node_id DESC NULLS LAST, source_url DESC NULLS LAST, content_type DESC NULLS LAST, creator_uid DESC NULLS LAST, permission_hash DESC NULLS LAST, extension DESC NULLS LAST,
    updated DESC NULLS LAST, source_hash DESC NULLS LAST, extracted_hash DESC NULLS LAST, extracted_chars DESC NULLS LAST) = 1
), texts AS (
  SELECT upper({strip_sql('source_id')}) AS source_id, * EXCLUDE (source_id) FROM semantic_output
  QUALIFY row_number() OVER (PARTITION BY upper({strip_sql('source_id')}) ORDER BY generated_at DESC NULLS LAST) = 1
), docs AS (
  SELECT e.*, t.* EXCLUDE (source_id, file_name, extension) FROM each e LEFT JOIN texts t USING (source_id) WHERE e.k = e.n
), d AS (
  SELECT *, (SELECT 1) AS one FROM docs
)
"""


def _tables(spark, folder):
    return [table(spark, folder, t) for t in ("raw_manifest", "snapshots", "semantic_output")]


def _docs(spark, folder):
    return documents(*_tables(spark, folder))


def _each(spark, folder):
    manifest, snapshots, _ = _tables(spark, folder)
    return listing(manifest, snapshots, last_only=False)


def _members(rule):
    return lambda spark, folder: rule(_docs(spark, folder)).drop("rule")


def _pairs(rule):
    return lambda spark, folder: relations.pairs_within(rule(_docs(spark, folder))).select("source_id", "target_id", "form").distinct()


def _names(spark, folder):
    m = table(spark, folder, "raw_manifest").select("file_name", "node_id", "source_url").distinct()
    return m.select(
        "file_name",
        "node_id",
        T.stable_id("KB", F.lit("WS1"), F.col("node_id")).alias("stable_id"),
        T.title_key(F.col("file_name")).alias("title_key"),
        F.col("file_name").rlike(T.VERSION_MARK).alias("has_version"),
        T.plain_url(F.col("source_url")).alias("url"),
    ).distinct()


def _word_counts(spark, folder):
    text = F.concat_ws("\n", "file_name", "core_theme", F.array_join("keywords", "\n"))
    return _docs(spark, folder).select("source_id", F.explode(F.array_distinct(T.words(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("documents"))


def _secrets(spark, folder):
    text, labels = T.without_secrets(F.col("text"))
    return table(spark, folder, "documents").where(F.col("text").isNotNull()).select("doc_id", F.sha2(text, 256).alias("text_hash"), F.array_join(labels, ",").alias("labels"))


def _ages(spark, folder):
    rows = table(spark, folder, "raw_manifest").select("update_time").distinct().withColumn("t", instant_micros("update_time"))
    local = F.date_format(F.timestamp_micros(F.col("t") + 8 * 3600 * 1_000_000), "yyyy-MM-dd HH:mm:ss")
    return rows.select("update_time", F.col("t").alias("micros"), local.alias("local_time"), F.floor((F.unix_micros(F.lit("2026-05-01T00:00:00Z").cast("timestamp")) - F.col("t")) / 86_400_000_000).cast("bigint").alias("age_days"))


def _profile_lists(spark, folder):
    return _docs(spark, folder).select("source_id", F.array_join(T.clean_list(F.col("keywords"), 6, 40), "|").alias("keywords"), F.array_join(T.clean_list(F.col("version_signals"), 8, 60), "|").alias("signals"))


def _edges(spark, folder):
    docs = cut(_docs(spark, folder), "docs")  # each rule would plan and read the listing again
    return relations.scored_edges(relations.evidence(docs))


def _whole_edges(spark, folder):
    return relations.whole_edges(_docs(spark, folder))


def _missing(spark, folder):
    return incremental.missing_runs(_each(spark, folder), incremental.numbered_scans(table(spark, folder, "snapshots")))


def _state(spark, folder):
    return incremental.applied_state(readings(table(spark, folder, "raw_manifest")), incremental.numbered_scans(table(spark, folder, "snapshots")))


QUERIES = {
    "current_documents": lambda s, d: _docs(s, d).select("source_id", "file_name", "source_path", "extension", "updated", "source_hash", F.sha2("content", 256).alias("content_hash"), F.size(F.coalesce("keywords", F.array())).alias("n_keywords")),
    "names_and_links": _names,
    "word_document_frequency": _word_counts,
    "secrets_redacted": _secrets,
    "instants_and_ages": _ages,
    "profile_lists": _profile_lists,
    "same_content_members": _members(relations.same_content),
    "same_title_members": _members(relations.same_title),
    "same_title_pairs": _pairs(relations.same_title),
    "same_business_id_members": _members(relations.same_business_id),
    "same_folder_members": _members(relations.same_folder),
    "same_folder_pairs": _pairs(relations.same_folder),
    "linked_nodes": lambda s, d: relations.linked_nodes(_docs(s, d)),
    "mentioned_ids": lambda s, d: relations.mentioned_ids(_docs(s, d)),
    "cited_titles": lambda s, d: relations.cited_titles(_docs(s, d)),
    "output_to_input": lambda s, d: relations.output_to_input(_docs(s, d)),
    "complementary_roles": lambda s, d: relations.complementary_roles(_docs(s, d)),
    "cosine_neighbours": lambda s, d: neighbours.cosine_neighbours(_docs(s, d)),
    "nearest_documents": lambda s, d: neighbours.nearest_documents(_docs(s, d)).drop("class_id"),
    "scored_edges": _edges,
    "edge_degrees": lambda s, d: relations.degrees(_edges(s, d)),
    "whole_edges": _whole_edges,
    "whole_edge_degrees": lambda s, d: relations.whole_degrees(_docs(s, d)),
    "capped_edges": lambda s, d: relations.whole_capped(_docs(s, d), 30),
    "folder_index": lambda s, d: folders.folder_index(_docs(s, d)),
    "latest_per_department": lambda s, d: folders.top_per_folder(_docs(s, d)),
    "sampled_relations": lambda s, d: folders.hash_sample(table(s, d, "relation_verification").select("relation_id").distinct(), "relation_id", 0.2),
    "creator_report": lambda s, d: folders.creator_report(_docs(s, d)),
    "length_report": lambda s, d: folders.length_report(_docs(s, d)),
    "content_batches": lambda s, d: folders.batches(_docs(s, d)),
    "change_flags": lambda s, d: incremental.change_flags(_each(s, d)),
    "change_flag_counts": lambda s, d: incremental.change_flags(_each(s, d)).groupBy("snapshot_id", "change_type").agg(F.count(F.lit(1)).alias("records")),
    "missing_records": _missing,
    "reclassified_content": lambda s, d: incremental.reclassified(_each(s, d)),
    "applied_state": _state,
}

_FOLD = "regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_VERSION = "(?i)[-_｜| ]?(?:v(?:er(?:sion)?)?\\s*\\d+(?:\\.\\d+)*|新版|旧版|最新版|修订版|最终版|草稿版|\\d{4}[-_/]\\d{1,2}[-_/]\\d{1,2})"
_MARK = "(?i)新版|旧版|最新版|修订|替代|取代|废止|失效|沿用|v\\s*\\d+(?:\\.\\d+)*|version\\s*\\d+(?:\\.\\d+)*"


def _key(c: str) -> str:
    stem = f"regexp_replace({c}, '(.)\\.[^./\\\\]*$', '\\1')"
    stem = f"regexp_replace({stem}, '(?i)\\[[A-Z][A-Z0-9_-]+-[A-F0-9]{{12}}\\]', '', 'g')"
    return _FOLD.format(f"regexp_replace({stem}, '{_VERSION}', '', 'g')")


def _member_sql(rows: str, least: int = 2) -> str:
    return f"""{_EACH}, own AS (SELECT DISTINCT bucket, source_id FROM ({rows}) WHERE bucket <> '')
SELECT bucket, source_id, members FROM (SELECT *, count(*) OVER (PARTITION BY bucket) AS members FROM own) WHERE members >= {least}"""


def _pair_sql(rows: str, whole: bool = False) -> str:
    """Pairs of buckets up to the limit and links of larger ones; or all pairs of all buckets."""
    if whole:
        return f"""{_EACH}, own AS (SELECT DISTINCT bucket, source_id FROM ({rows}) WHERE bucket <> '')
SELECT DISTINCT a.source_id, b.source_id AS target_id, 'pair' AS form FROM own a JOIN own b ON a.bucket = b.bucket AND a.source_id < b.source_id"""
    return f"""{_EACH}, own AS (SELECT DISTINCT bucket, source_id FROM ({rows}) WHERE bucket <> ''),
sized AS (SELECT *, count(*) OVER (PARTITION BY bucket) AS members, min(source_id) OVER (PARTITION BY bucket) AS first FROM own)
SELECT DISTINCT a.source_id, b.source_id AS target_id, 'pair' AS form FROM sized a JOIN sized b ON a.bucket = b.bucket AND a.source_id < b.source_id WHERE a.members <= {relations.PAIR_LIMIT}
UNION SELECT DISTINCT first, source_id, 'member' FROM sized WHERE members > {relations.PAIR_LIMIT} AND source_id <> first"""


_TITLE_ROWS = f"""SELECT bucket, source_id FROM (
  SELECT *, bool_or(marked) OVER (PARTITION BY bucket) AS any_marked FROM (
    SELECT {_key('file_name')} AS bucket, source_id, regexp_matches(file_name, '{_MARK}') OR coalesce(len(version_signals), 0) > 0 AS marked FROM docs) WHERE length(bucket) >= 4) WHERE any_marked"""
_FOLDER_ROWS = "SELECT regexp_extract(source_path, '^(.*)/[^/]*$', 1) AS bucket, source_id FROM docs"
_ID_ROWS = f"""SELECT unnest(list_distinct(list_transform(list_concat({', '.join(f"regexp_extract_all(t, '{p}')" for p in T.BUSINESS_IDS)}), lambda x: replace(upper(x), ' ', '')))) AS bucket, source_id
FROM (SELECT concat_ws(chr(10), file_name, content) AS t, source_id FROM docs)"""
_NODES = """SELECT DISTINCT f.source_id, t.target_id FROM (SELECT source_id, unnest(list_distinct(regexp_extract_all(content, 'https?://[^\\s/]+/(?:i/)?(?:nodes|spaces)/([A-Za-z0-9_-]+)', 1))) AS node_id FROM docs) f
JOIN (SELECT node_id, min(source_id) AS target_id FROM docs WHERE trim(node_id) <> '' GROUP BY 1) t USING (node_id) WHERE f.source_id <> t.target_id"""
_IDS = """SELECT DISTINCT f.source_id, f.target_id FROM (SELECT source_id, upper(unnest(regexp_extract_all(content, '(?i)\\b[A-Z][A-Z0-9_-]{1,20}-[A-F0-9]{12}\\b'))) AS target_id FROM docs) f
WHERE f.source_id <> f.target_id AND f.target_id IN (SELECT source_id FROM docs)"""
_CITED = f"""SELECT DISTINCT f.source_id, t.target_id FROM (
  SELECT source_id, {_key('title')} AS key FROM (SELECT source_id, unnest(list_concat(coalesce(regexp_extract_all(content, '{T.TITLE_CITED}', 1), []), coalesce(list_transform(explicit_references, lambda r: r.target_text), []))) AS title FROM docs)) f
JOIN (SELECT {_key('file_name')} AS key, min(source_id) AS target_id FROM docs GROUP BY 1 HAVING count(*) = 1) t USING (key) WHERE key <> '' AND f.source_id <> t.target_id"""
_BUCKETS = {"same content": "SELECT sha256(content) AS bucket, source_id FROM docs WHERE trim(content) <> ''", "same title": _TITLE_ROWS, "same business id": _ID_ROWS, "same folder": _FOLDER_ROWS}


def _evidence_sql(whole: bool = False) -> str:
    parts = [f"SELECT source_id, target_id, 'linked node' AS rule FROM ({_NODES})", f"SELECT source_id, target_id, 'mentioned id' FROM ({_IDS})", f"SELECT source_id, target_id, 'cited title' FROM ({_CITED})"]
    parts += [f"SELECT DISTINCT source_id, target_id, '{rule}' FROM ({_pair_sql(rows, whole).replace(_EACH + ',', 'WITH')})" for rule, rows in _BUCKETS.items()]
    return ", ev AS (\n" + "\nUNION ALL ".join(parts) + ")"


_EVIDENCE = _evidence_sql()
_W = {k: (s, w) for k, (s, w) in relations.STRENGTH.items()}
_N = {k: "count(*) FILTER (rule IN (" + ", ".join(f"'{r}'" for r, (s, _) in _W.items() if s == k) + "))" for k in ("strong", "medium", "weak")}
_BEST = "max(CASE rule " + " ".join(f"WHEN '{r}' THEN {w}" for r, (_, w) in _W.items()) + " END)"
_SCORED = f"SELECT source_id, target_id, string_agg(DISTINCT rule, '/' ORDER BY rule) AS rules, {_N['strong']} AS strong, {_N['medium']} AS medium, {_N['weak']} AS weak, round({_N['strong']} * 100 + {_N['medium']} * 20 + {_N['weak']} * 2 + {_BEST}, 4)::DOUBLE AS score FROM ev GROUP BY ALL"
_NEAREST = """w AS (SELECT source_id, unnest(regexp_extract_all(lower(concat_ws(chr(10), file_name, summary, core_theme, array_to_string(keywords, chr(10)), array_to_string(business_objects, chr(10)))), '[a-z][a-z0-9_-]{1,}|\\d{2,}|[一-鿿]{2,}')) AS w FROM docs),
t AS (SELECT source_id, unnest(CASE WHEN regexp_full_match(w, '[一-鿿]{3,}') THEN list_transform(range(1, length(w)), lambda i: substr(w, i, 2)) ELSE [w] END) AS word FROM w),
c AS (SELECT source_id, word, count(*) AS c FROM t GROUP BY ALL),
x AS (SELECT *, (1 + ln(c)) * (ln((1 + (SELECT count(*) FROM docs)) / (1 + count(*) OVER (PARTITION BY word))) + 1) AS w FROM c),
u AS (SELECT source_id, word, w / sqrt(sum(w * w) OVER (PARTITION BY source_id)) AS weight FROM x),
p AS (SELECT a.source_id, b.source_id AS target_id, round(sum(a.weight * b.weight), 6) AS cosine FROM u a JOIN u b ON a.word = b.word AND a.source_id <> b.source_id GROUP BY ALL),
nearest AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY cosine DESC, target_id) AS rank FROM p WHERE cosine >= 0.12 QUALIFY rank <= 10)"""
_WHOLE_EVIDENCE = f"""{_evidence_sql(True)}, {_NEAREST},
sides AS (SELECT DISTINCT {_FOLD.format('x')} AS bucket, source_id, side FROM (SELECT unnest(outputs) AS x, source_id, 'output' AS side FROM docs UNION ALL SELECT unnest(inputs), source_id, 'input' FROM docs)),
objects AS (SELECT * FROM (SELECT DISTINCT {_FOLD.format('x')} AS bucket, source_id, coalesce(nullif({strip_sql('document_role')}, ''), nullif({strip_sql('page_type_candidate')}, '')) AS role FROM (SELECT unnest(business_objects) AS x, * FROM docs)) WHERE length(bucket) >= 2),
fits(a, b) AS (VALUES {', '.join(f"('{a}', '{b}'), ('{b}', '{a}')" for a, b in relations.ROLE_PAIRS)}),
whole AS (SELECT source_id, target_id, rule, NULL::DOUBLE AS cosine FROM ev
UNION ALL SELECT DISTINCT a.source_id, b.source_id, 'output to input', NULL FROM sides a JOIN sides b ON a.bucket = b.bucket AND a.source_id <> b.source_id AND a.side = 'output' AND b.side = 'input' WHERE length(a.bucket) >= 2
UNION ALL SELECT DISTINCT x.source_id, y.source_id, 'complementary roles', NULL FROM objects x JOIN objects y ON x.bucket = y.bucket AND x.source_id < y.source_id WHERE EXISTS (SELECT 1 FROM fits WHERE contains(x.role, a) AND contains(y.role, b))
UNION ALL SELECT least(source_id, target_id), greatest(source_id, target_id), 'near words', max(cosine) FROM nearest GROUP BY ALL)"""
_WV = {k: "count(*) FILTER (rule IN (" + ", ".join(f"'{r}'" for r, (s, _) in relations.WHOLE_STRENGTH.items() if s == k) + "))" for k in ("strong", "medium", "weak")}
_WBEST = "max(coalesce(cosine, CASE rule " + " ".join(f"WHEN '{r}' THEN {w}" for r, (_, w) in relations.WHOLE_STRENGTH.items()) + " END))"
_WHOLE = f"SELECT source_id, target_id, string_agg(DISTINCT rule, '/' ORDER BY rule) AS rules, {_WV['strong']} AS strong, {_WV['medium']} AS medium, {_WV['weak']} AS weak, floor(({_WV['strong']} * 100 + {_WV['medium']} * 20 + {_WV['weak']} * 2 + {_WBEST}) * 10000 + 0.500001) / 10000 AS score FROM whole GROUP BY source_id, target_id"
_CHANGES = """, pairs AS (
  SELECT coalesce(n.k, o.k + 1) AS k, coalesce(n.source_id, o.source_id) AS source_id, n.source_id IS NOT NULL AS here, o.source_id IS NOT NULL AS before,
    list_filter([
      CASE WHEN n.updated IS DISTINCT FROM o.updated THEN 'content_check' END,
      CASE WHEN n.permission_hash <> o.permission_hash THEN 'permission_changed' END,
      CASE WHEN n.source_path IS DISTINCT FROM o.source_path THEN 'moved' END,
      CASE WHEN n.file_name IS DISTINCT FROM o.file_name THEN 'renamed' END,
      CASE WHEN (trim(n.creator_uid) <> '' AND n.creator_uid IS DISTINCT FROM o.creator_uid) OR (trim(n.extension) <> '' AND n.extension IS DISTINCT FROM o.extension)
             OR (trim(n.content_type) <> '' AND n.content_type IS DISTINCT FROM o.content_type) OR (trim(n.source_url) <> '' AND n.source_url IS DISTINCT FROM o.source_url) THEN 'metadata_changed' END], lambda x: x IS NOT NULL) AS f
  FROM each n FULL OUTER JOIN each o ON n.source_id = o.source_id AND n.k = o.k + 1
), flagged AS (
  SELECT s.snapshot_id, source_id, CASE WHEN NOT here THEN ['missing'] WHEN NOT before THEN ['new'] WHEN len(f) = 0 THEN ['unchanged'] ELSE f END AS f FROM pairs JOIN scans s USING (k) WHERE k > 1
)"""
_UP = """, up AS (SELECT source_id, source_path, string_split(source_path, '/') AS p FROM docs WHERE contains(source_path, '/')),
below AS (SELECT source_id, i, len(p) - 1 AS n, array_to_string(p[1:i], '/') AS folder FROM (SELECT *, unnest(range(1, len(p))) AS i FROM up))"""

ORACLES = {
    "current_documents": f"{_EACH} SELECT source_id, file_name, source_path, extension, updated, source_hash, sha256(content) AS content_hash, coalesce(len(keywords), 0) AS n_keywords FROM docs",
    "names_and_links": f"""SELECT DISTINCT file_name, node_id, 'KB-' || upper(substr(sha256('WS1:' || node_id), 1, 12)) AS stable_id, {_key('file_name')} AS title_key, regexp_matches(file_name, '{_MARK}') AS has_version,
CASE WHEN list_has_any(list_transform(string_split(regexp_extract(source_url, '\\?([^#]*)', 1), '&'), lambda p: lower(split_part(p, '=', 1))), {list(T.SIGNED_KEYS)}) THEN regexp_replace(source_url, '[?#].*$', '') ELSE source_url END AS url FROM raw_manifest""",
    "word_document_frequency": f"""{_EACH}, w AS (SELECT source_id, unnest(regexp_extract_all(lower(concat_ws(chr(10), file_name, core_theme, array_to_string(keywords, chr(10)))), '[a-z][a-z0-9_-]{{1,}}|\\d{{2,}}|[一-鿿]{{2,}}')) AS w FROM docs),
t AS (SELECT source_id, unnest(CASE WHEN regexp_full_match(w, '[一-鿿]{{3,}}') THEN list_transform(range(1, length(w)), lambda i: substr(w, i, 2)) ELSE [w] END) AS word FROM w)
SELECT word, count(DISTINCT source_id) AS documents FROM t GROUP BY 1""",
    "secrets_redacted": """WITH a AS (SELECT doc_id, text AS t0, regexp_replace(text, '(?i)((?:访问)?密码|password|passcode)(\\s*[:：=]\\s*)([^\\s,，;；。]{3,})', '\\1\\2[REDACTED]', 'g') AS t1 FROM documents WHERE text IS NOT NULL),
b AS (SELECT *, regexp_replace(t1, '(?i)(api[_ -]?key|access[_ -]?token|refresh[_ -]?token|secret|bearer)(\\s*[:：=]?\\s*)([A-Za-z0-9_./+\\-=]{6,})', '\\1\\2[REDACTED]', 'g') AS t2 FROM a),
c AS (SELECT *, regexp_replace(t2, '-----BEGIN [A-Z ]*PRIVATE KEY-----[\\s\\S]*?-----END [A-Z ]*PRIVATE KEY-----', '[REDACTED PRIVATE KEY]', 'g') AS t3 FROM b)
SELECT doc_id, sha256(t3) AS text_hash, concat_ws(',', CASE WHEN t1 <> t0 OR regexp_matches(t0, '(?i)((?:访问)?密码|password|passcode)(\\s*[:：=]\\s*)([^\\s,，;；。]{3,})') THEN 'password' END,
CASE WHEN regexp_matches(t1, '(?i)(api[_ -]?key|access[_ -]?token|refresh[_ -]?token|secret|bearer)(\\s*[:：=]?\\s*)([A-Za-z0-9_./+\\-=]{6,})') THEN 'token' END, CASE WHEN t3 <> t2 THEN 'private key' END) AS labels FROM c""",
    "instants_and_ages": f"""WITH u AS (SELECT DISTINCT update_time FROM raw_manifest), t AS (SELECT update_time, {micros_sql(strip_sql('update_time'))} AS micros FROM u)
SELECT update_time, micros, strftime(make_timestamp(micros + 28800000000), '%Y-%m-%d %H:%M:%S') AS local_time, CAST(floor((epoch_us(TIMESTAMP '2026-05-01') - micros) / 86400000000) AS BIGINT) AS age_days FROM t""",
    "profile_lists": f"{_EACH}, l AS (SELECT source_id, list_filter(list_transform(keywords, lambda x: substr(trim(regexp_replace(x, '\\s+', ' ', 'g')), 1, 40)), lambda x: x <> '') AS l_keywords, list_filter(list_transform(version_signals, lambda x: substr(trim(regexp_replace(x, '\\s+', ' ', 'g')), 1, 60)), lambda x: x <> '') AS l_version_signals FROM docs) SELECT source_id, array_to_string(list_filter(l_keywords, lambda x, i: list_position(l_keywords, x) = i)[1:6], '|') AS keywords, array_to_string(list_filter(l_version_signals, lambda x, i: list_position(l_version_signals, x) = i)[1:8], '|') AS signals FROM l",
    "content_batches": f"""{_EACH}, r AS (SELECT source_id, length(content) AS chars, CAST('0x' || substr(sha256(source_id), 1, 8) AS BIGINT) % 1024 AS lane FROM docs WHERE content IS NOT NULL)
SELECT source_id, CAST(lane AS INT) AS lane, CAST(floor(coalesce(sum(chars) OVER (PARTITION BY lane ORDER BY source_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 20000) AS INT) AS batch, CAST(chars AS BIGINT) AS chars FROM r""",
    "same_content_members": _member_sql("SELECT sha256(content) AS bucket, source_id FROM docs WHERE trim(content) <> ''"),
    "same_title_members": _member_sql(_TITLE_ROWS),
    "same_title_pairs": _pair_sql(_TITLE_ROWS),
    "same_business_id_members": _member_sql(_ID_ROWS),
    "same_folder_members": _member_sql(_FOLDER_ROWS),
    "same_folder_pairs": _pair_sql(_FOLDER_ROWS),
    "linked_nodes": f"{_EACH} {_NODES}",
    "mentioned_ids": f"{_EACH} {_IDS}",
    "cited_titles": f"{_EACH} {_CITED}",
    "output_to_input": f"""{_EACH}, r AS (SELECT DISTINCT {_FOLD.format('x')} AS bucket, source_id, side FROM (SELECT unnest(outputs) AS x, source_id, 'output' AS side FROM docs UNION ALL SELECT unnest(inputs), source_id, 'input' FROM docs))
SELECT * FROM (SELECT *, count(*) FILTER (side = 'output') OVER (PARTITION BY bucket) AS outputs, count(*) FILTER (side = 'input') OVER (PARTITION BY bucket) AS inputs FROM r WHERE length(bucket) >= 2) WHERE outputs > 0 AND inputs > 0""",
    "complementary_roles": f"""{_EACH}, r AS (SELECT DISTINCT {_FOLD.format('x')} AS bucket, source_id, role FROM (SELECT unnest(business_objects) AS x, source_id, coalesce(nullif({strip_sql('document_role')}, ''), nullif({strip_sql('page_type_candidate')}, '')) AS role FROM docs) WHERE role IS NOT NULL),
p(a, b) AS (VALUES {', '.join(f"('{a}', '{b}'), ('{b}', '{a}')" for a, b in relations.ROLE_PAIRS)})
SELECT x.bucket, x.source_id, x.role, count(DISTINCT y.source_id) AS partners FROM r x JOIN r y ON x.bucket = y.bucket AND x.source_id <> y.source_id AND EXISTS (SELECT 1 FROM p WHERE contains(x.role, a) AND contains(y.role, b)) WHERE x.bucket <> '' GROUP BY ALL""",
    "cosine_neighbours": f"""{_EACH}, w AS (SELECT source_id, unnest(regexp_extract_all(lower(concat_ws(chr(10), file_name, core_theme, array_to_string(keywords, chr(10)))), '[a-z][a-z0-9_-]{{1,}}|\\d{{2,}}|[一-鿿]{{2,}}')) AS w FROM docs),
t AS (SELECT source_id, unnest(CASE WHEN regexp_full_match(w, '[一-鿿]{{3,}}') THEN list_transform(range(1, length(w)), lambda i: substr(w, i, 2)) ELSE [w] END) AS word FROM w),
c AS (SELECT source_id, word, count(*) AS c FROM t GROUP BY ALL),
x AS (SELECT *, (1 + ln(c)) * (ln((1 + (SELECT count(*) FROM docs)) / (1 + count(*) OVER (PARTITION BY word))) + 1) AS w FROM c),
u AS (SELECT source_id, word, w / sqrt(sum(w * w) OVER (PARTITION BY source_id)) AS weight FROM x),
n AS (SELECT source_id, string_agg(word || '=' || printf('%.9f', weight), chr(10) ORDER BY word) AS name FROM u GROUP BY 1),
v AS (SELECT u.* FROM u WHERE source_id IN (SELECT min(source_id) FROM n GROUP BY name)),
p AS (SELECT a.source_id, b.source_id AS target_id, round(sum(a.weight * b.weight), 6) AS cosine FROM v a JOIN v b ON a.word = b.word AND a.source_id <> b.source_id GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY cosine DESC, target_id) AS rank FROM p WHERE cosine >= 0.5 QUALIFY rank <= 10""",
    "nearest_documents": f"{_EACH}, {_NEAREST} SELECT * FROM nearest",
    "scored_edges": f"{_EACH}{_EVIDENCE} {_SCORED}",
    "edge_degrees": f"{_EACH}{_EVIDENCE}, s AS ({_SCORED}) SELECT source_id, count(*) AS degree FROM (SELECT source_id FROM s UNION ALL SELECT target_id FROM s) GROUP BY 1",
    "whole_edges": f"{_EACH}{_WHOLE_EVIDENCE} {_WHOLE}",
    "whole_edge_degrees": f"{_EACH}{_WHOLE_EVIDENCE}, s AS ({_WHOLE}) SELECT source_id, count(*) AS degree FROM (SELECT source_id FROM s UNION ALL SELECT target_id FROM s) GROUP BY 1",
    "folder_index": f"""{_EACH}{_UP} SELECT c.folder, len(string_split(c.folder, '/')) AS depth, documents, coalesce(folders, 0) AS folders, all_documents
FROM (SELECT folder, count(*) FILTER (i = n) AS documents, count(*) AS all_documents FROM below GROUP BY 1) c
LEFT JOIN (SELECT regexp_extract(folder, '^(.*)/[^/]*$', 1) AS folder, count(*) AS folders FROM (SELECT DISTINCT folder FROM below WHERE contains(folder, '/')) GROUP BY 1) f USING (folder)""",
    "latest_per_department": f"{_EACH} SELECT split_part(source_path, '/', 1) AS department, row_number() OVER (PARTITION BY split_part(source_path, '/', 1) ORDER BY updated DESC, source_id) AS rank, source_id, updated FROM docs WHERE updated IS NOT NULL QUALIFY rank <= 3",
    "sampled_relations": f"SELECT DISTINCT relation_id FROM relation_verification WHERE CAST('0x' || substr(sha256(relation_id), 1, 8) AS BIGINT) < {int(0.2 * (1 << 32))}",
    "creator_report": f"{_EACH} SELECT nullif(trim(creator_uid), '') AS creator_uid, count(*) AS documents, count(DISTINCT regexp_extract(source_path, '^(.*)/[^/]*$', 1)) AS folders, max(updated) AS last_updated FROM docs GROUP BY 1",
    "length_report": f"{_EACH} SELECT extension, count(*) AS documents, count(*) FILTER (coalesce(extracted_chars, 0) = 0) AS without_length, count(*) FILTER (coalesce(extracted_chars, 0) <> 0 AND extracted_chars <> length(content)) AS wrong_length FROM docs WHERE content IS NOT NULL GROUP BY 1",
    "change_flags": f"{_EACH}{_CHANGES} SELECT snapshot_id, source_id, f[1] AS change_type, array_to_string(f, ',') AS flags, list_contains(f, 'new') OR list_contains(f, 'content_check') AS needs_extraction FROM flagged",
    "change_flag_counts": f"{_EACH}{_CHANGES} SELECT snapshot_id, f[1] AS change_type, count(*) AS records FROM flagged GROUP BY ALL",
    "missing_records": f"{_EACH} SELECT source_id, s.snapshot_id AS last_seen, CAST(e.n - e.k AS INT) AS missing_scans FROM (SELECT source_id, max(k) AS k, any_value(n) AS n FROM each GROUP BY 1) e JOIN scans s ON s.k = e.k WHERE e.k < e.n",
    "reclassified_content": f"""{_EACH} SELECT s.snapshot_id, n.source_id, CASE WHEN n.extracted_hash <> o.extracted_hash THEN 'content_changed'
WHEN n.extracted_hash = o.extracted_hash AND n.source_hash IS DISTINCT FROM o.source_hash THEN 'file_changed_text_unchanged' WHEN n.extracted_hash = o.extracted_hash THEN 'metadata_only'
WHEN n.source_hash <> o.source_hash THEN 'content_changed' WHEN n.source_hash = o.source_hash THEN 'metadata_only' ELSE 'content_unresolved' END AS outcome
FROM each n JOIN each o ON n.source_id = o.source_id AND n.k = o.k + 1 JOIN scans s ON s.k = n.k WHERE n.updated IS DISTINCT FROM o.updated""",
    "applied_state": f"{_EACH} SELECT source_id, snapshot_id, file_name, source_hash FROM each QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY k DESC) = 1",
}
