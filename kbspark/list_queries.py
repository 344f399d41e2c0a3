"""Queries on lists, sets, orders and messages, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from kbspark.document_queries import _CHANGES, _EACH, _docs, _each, _hash_sql
from kbspark.functions import markup, messages
from kbspark.functions.text import blank_to_null, canonical_id
from kbspark.operators import incremental, lists, order, quality
from kbspark.operators.documents import contents, listing
from kbspark.operators.snapshots import complete_scans
from kbspark.snapshot_queries import strip_sql
from kbspark.sources.tables import table

_INCLUDE, _EXCLUDE = ("流程质量部", "渠道拓展部/专题06"), ("流程质量部/专题24",)


def _relations(spark, folder):
    return lists.current_relations(table(spark, folder, "relation_verification"))


def _listing(spark, folder):
    return listing(table(spark, folder, "raw_manifest"), table(spark, folder, "snapshots"))


def _last_two(spark, folder):
    """The listings of the last complete scan and of the one before."""
    each = _each(spark, folder)
    scans = complete_scans(table(spark, folder, "snapshots"))
    last = scans.where("next_snapshot_id is null").select(F.col("snapshot_id").alias("last"))
    return each.where("next_snapshot_id is null"), each.join(F.broadcast(last), F.col("next_snapshot_id") == F.col("last"))


def _scans(spark, folder):
    return incremental.numbered_scans(table(spark, folder, "snapshots"))


def _texts(spark, folder):
    rows = table(spark, folder, "semantic_output").select(canonical_id("source_id").alias("source_id"), "content").where("source_id is not null and content is not null").distinct()
    return rows


def _endings(spark, folder):
    """The last line of each content with four visible characters or more, its last 180; long contents go through Arrow batches."""
    lines = _texts(spark, folder).select("source_id", F.posexplode(messages.last_lines(F.col("content"))).alias("k", "line"))
    seen = lines.withColumn("visible", messages.visible_characters("line")).where(F.length("visible") >= 4)
    return seen.groupBy("source_id").agg(F.min(F.struct("k", F.substring("visible", -180, 180).alias("ending"))).alias("r")).select("source_id", "r.ending")


def _fingerprints(spark, folder):
    f = ("file_name", "source_path", "creator_uid", "source_hash", "permission_hash")
    return _listing(spark, folder).select("source_id", messages.fingerprint(**{c: F.col(c) for c in f}).alias("fingerprint"))


def _sizes(spark, folder):
    docs = _docs(spark, folder).where("content is not null")
    return docs.select("source_id", F.split_part("source_path", F.lit("/"), F.lit(1)).alias("department"), F.length("content").cast("bigint").alias("chars"))


def _conflicts(spark, folder):
    flagged = table(spark, folder, "relation_verification").select(blank_to_null("relation_id").alias("relation_id"), F.explode(messages.json_list(F.col("risk_flags"))).alias("flag")).where("flag = '冲突'").select("relation_id").distinct()
    now, before = (x.select("source_id", F.coalesce("extracted_hash", "source_hash").alias("content_hash")) for x in _last_two(spark, folder))
    return lists.conflict_signatures(_relations(spark, folder).join(flagged, "relation_id", "left_semi").select("relation_id", "source_id", "target_id"), now, before)


def _change_list(spark, folder):
    """The changes of each scan, the most pressing first, then by id: every change with its place in the list."""
    kind = F.array_position(F.array(*map(F.lit, incremental.KINDS)), F.col("change_type"))
    changes = incremental.change_flags(_each(spark, folder)).where("change_type <> 'unchanged'").select("snapshot_id", "source_id", "change_type", kind.alias("kind"))
    return order.numbered(changes, "snapshot_id", "kind", "source_id").select("snapshot_id", "source_id", "change_type", F.col("n").alias("place"))


def _titles(spark, folder):
    title, rest = markup.title_and_rest(F.col("content"))
    return _texts(spark, folder).select("source_id", title.alias("title"), F.sha2(rest, 256).alias("rest_hash"))


QUERIES = {
    "related_documents": lambda s, d: lists.related_documents(_relations(s, d)),
    "relations_by_type": lambda s, d: lists.relations_by_type(_relations(s, d)),
    "review_levels": lambda s, d: lists.review_levels(_relations(s, d)),
    "relation_creators": lambda s, d: lists.relation_creators(_relations(s, d), _listing(s, d), quality.creator_names(table(s, d, "raw_manifest"))),
    "content_profiles": lambda s, d: lists.content_profiles(_listing(s, d), table(s, d, "semantic_output")),
    "first_per_content": lambda s, d: lists.first_per_content(_listing(s, d)),
    "folder_differences": lambda s, d: lists.folder_differences(*_last_two(s, d)[::-1]),
    "id_differences": lambda s, d: lists.id_differences(_listing(s, d), contents(table(s, d, "semantic_output"))),
    "current_and_absent": lambda s, d: lists.with_absent(*_last_two(s, d)),
    "selected_paths": lambda s, d: lists.selected_paths(_listing(s, d), _INCLUDE, _EXCLUDE).select("source_id", "source_path"),
    "page_types": lambda s, d: lists.page_types(_docs(s, d)),
    "metadata_times": lambda s, d: lists.metadata_times(_listing(s, d), _relations(s, d)),
    "parse_failures": lambda s, d: quality.parse_failures(table(s, d, "raw_manifest")),
    "change_states": lambda s, d: incremental.change_states(_each(s, d), _scans(s, d)),
    "working_set": lambda s, d: incremental.working_set(_each(s, d), _scans(s, d)),
    "path_batches": lambda s, d: order.batches_of(_listing(s, d).select("source_id", "source_path"), 30, "source_path", "source_id"),
    "lowest_share_of_relations": lambda s, d: order.lowest_share(_relations(s, d).select("relation_id"), "relation_id", 0.2),
    "spaced_documents": lambda s, d: order.spaced(_sizes(s, d).select("source_id", "chars"), 12, "chars", "source_id"),
    "content_packs": lambda s, d: order.packed(_sizes(s, d), "department", "chars", 15, 20_000, "source_id"),
    "row_fingerprints": _fingerprints,
    "plain_urls": lambda s, d: _texts(s, d).select("source_id", F.sha2(messages.plain_urls(F.col("content")), 256).alias("text_hash")),
    "safe_messages": lambda s, d: _texts(s, d).select("source_id", messages.safe_message(F.col("content")).alias("message")),
    "safe_names": lambda s, d: table(s, d, "raw_manifest").select("file_name").distinct().select("file_name", messages.safe_name(F.col("file_name"), 20).alias("safe"), messages.inline_text(F.col("file_name"), 20).alias("inline")),
    "risk_flags": lambda s, d: table(s, d, "relation_verification").select("relation_id", F.explode(messages.json_list(F.col("risk_flags"))).alias("flag")).where(blank_to_null("relation_id").isNotNull()).distinct(),
    "stale_documents": lambda s, d: _docs(s, d).where(F.exists(F.concat(F.coalesce("version_signals", F.array().cast("array<string>")), F.array(F.coalesce("content", F.lit("")))), lambda x: x.rlike(messages.STALE))).select("source_id"),
    "visible_endings": _endings,
    "conflict_signatures": _conflicts,
    "unseen_contents": lambda s, d: lists.unseen_contents(_listing(s, d), _each(s, d).where("next_snapshot_id is not null")),
    "longest_names": lambda s, d: lists.longest_names(_listing(s, d)),
    "change_list": _change_list,
    "markdown_titles": _titles,
}

_REL = f"""rel AS (SELECT * FROM (SELECT nullif({strip_sql('relation_id')}, '') AS relation_id, nullif(upper({strip_sql('source_id')}), '') AS source_id, nullif(upper({strip_sql('target_id')}), '') AS target_id, lower({strip_sql('verification_status')}) AS status, nullif({strip_sql('verified_relation_type')}, '') AS type, nullif({strip_sql('review_level')}, '') AS level, verified_at FROM relation_verification) WHERE relation_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY relation_id ORDER BY verified_at DESC NULLS LAST, source_id DESC NULLS LAST, target_id DESC NULLS LAST, status DESC NULLS LAST, type DESC NULLS LAST, level DESC NULLS LAST) = 1)"""
_BOTH = """ends AS (SELECT source_id, target_id AS related_id, relation_id, type, 'source' AS side FROM rel WHERE status = 'confirmed' AND source_id <> target_id UNION ALL SELECT target_id, source_id, relation_id, type, 'target' FROM rel WHERE status = 'confirmed' AND source_id <> target_id)"""
_NAMES = f"names AS (SELECT nullif({strip_sql('creator_uid')}, '') AS creator_uid, first(nullif({strip_sql('creator_name')}, '') ORDER BY loaded_at DESC NULLS LAST, nullif({strip_sql('creator_name')}, '') DESC) FILTER ({strip_sql('creator_name')} <> '') AS name FROM raw_manifest WHERE {strip_sql('creator_uid')} <> '' GROUP BY 1)"
_TEXTS = f"texts1 AS (SELECT DISTINCT upper({strip_sql('source_id')}) AS source_id, content FROM semantic_output WHERE {strip_sql('source_id')} <> '' AND content IS NOT NULL)"
_UNDER = lambda ps: " OR ".join(f"source_path = '{p}' OR starts_with(source_path, '{p}/')" for p in ps)
_LAST = f"{_EACH}, last AS (SELECT * FROM each WHERE k = n), old AS (SELECT * FROM each WHERE k = n - 1)"
_FOLDER = "regexp_extract(source_path, '^(.*)/[^/]*$', 1)"
_SIZES = "sizes AS (SELECT source_id, split_part(source_path, '/', 1) AS department, length(content) AS chars FROM docs WHERE content IS NOT NULL)"
_SIGNED = "accesskeyid|ossaccesskeyid|signature|expires|security-token|x-oss-security-token|x-oss-signature|x-oss-credential|token|access_token"

ORACLES = {
    "related_documents": f"WITH {_REL}, {_BOTH} SELECT * FROM ends",
    "relations_by_type": f"WITH {_REL}, {_BOTH} SELECT source_id, type, count(DISTINCT relation_id) AS relations, count(DISTINCT related_id) AS related FROM ends GROUP BY 1, 2",
    "review_levels": f"WITH {_REL} SELECT level, count(*) AS relations, count(*) FILTER (status = 'confirmed') AS confirmed, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (coalesce(status, '') NOT IN ('confirmed', 'rejected')) AS pending FROM rel GROUP BY 1",
    "relation_creators": f"{_EACH}, {_REL}, {_NAMES}, own AS (SELECT source_id, name FROM docs LEFT JOIN names ON names.creator_uid = nullif({strip_sql('docs.creator_uid')}, '')) SELECT relation_id, coalesce(a.name, '未登记') AS source_creator, coalesce(b.name, '未登记') AS target_creator FROM rel LEFT JOIN own a ON a.source_id = rel.source_id LEFT JOIN own b ON b.source_id = rel.target_id",
    "content_profiles": f"""{_EACH}, p AS (SELECT {_hash_sql('document_key')} AS content_hash, upper({strip_sql('source_id')}) AS id, nullif({strip_sql('page_type_candidate')}, '') AS page_type FROM semantic_output WHERE {strip_sql('source_id')} <> ''),
q AS (SELECT *, count(*) OVER (PARTITION BY content_hash) AS rows FROM p WHERE content_hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY id, page_type NULLS FIRST) = 1)
SELECT e.source_id, content_hash, q.id AS profile_id, q.page_type, q.rows FROM each e JOIN q ON q.content_hash = coalesce(e.extracted_hash, e.source_hash) WHERE e.k = e.n""",
    "first_per_content": f"{_LAST} SELECT coalesce(extracted_hash, source_hash) AS content_hash, arg_min(source_id, (source_path, source_id)) AS source_id, min(source_path) AS source_path, count(*) AS copies FROM last WHERE coalesce(extracted_hash, source_hash) IS NOT NULL GROUP BY 1",
    "folder_differences": f"{_LAST}, a AS (SELECT DISTINCT {_FOLDER} AS folder, source_id FROM old WHERE contains(source_path, '/')), b AS (SELECT DISTINCT {_FOLDER} AS folder, source_id FROM last WHERE contains(source_path, '/')) SELECT *, 'missing' AS side FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'extra' FROM (FROM b EXCEPT FROM a)",
    "id_differences": f"{_LAST}, a AS (SELECT source_id FROM last), b AS (SELECT DISTINCT upper({strip_sql('source_id')}) AS source_id FROM semantic_output WHERE {strip_sql('source_id')} <> '') SELECT source_id, 'left' AS side FROM (FROM a EXCEPT FROM b) UNION ALL SELECT source_id, 'right' FROM (FROM b EXCEPT FROM a)",
    "current_and_absent": f"{_LAST} SELECT source_id, file_name, false AS kept FROM last UNION ALL SELECT source_id, file_name, true FROM old WHERE source_id NOT IN (SELECT source_id FROM last)",
    "selected_paths": f"{_LAST} SELECT source_id, source_path FROM last WHERE ({_UNDER(_INCLUDE)}) AND NOT ({_UNDER(_EXCLUDE)})",
    "page_types": f"{_EACH} SELECT nullif({strip_sql('page_type_candidate')}, '') AS page_type, count(*) AS documents, count(DISTINCT nullif({_FOLDER}, '')) AS folders, count(*) FILTER ({strip_sql('content')} <> '') AS with_content FROM docs GROUP BY 1",
    "metadata_times": f"{_LAST}, {_REL}, v AS (SELECT id, max(epoch_us(verified_at)) AS verified FROM (SELECT source_id AS id, verified_at FROM rel WHERE status = 'confirmed' UNION ALL SELECT target_id, verified_at FROM rel WHERE status = 'confirmed') GROUP BY 1) SELECT source_id, updated, verified, greatest(updated, verified) AS latest FROM last LEFT JOIN v ON v.id = source_id",
    "parse_failures": f"SELECT trim(parse_status) AS parse_status, coalesce(regexp_replace(lower({strip_sql('extension')}), '^\\.+', ''), '') AS extension, count(*) AS rows, count(DISTINCT upper({strip_sql('source_id')})) FILTER ({strip_sql('source_id')} <> '') AS records FROM raw_manifest WHERE NOT coalesce(trim(parse_status) = '全文已解析', false) GROUP BY 1, 2",
    "change_states": f"""{_EACH}, o AS (SELECT source_id, k, updated, n, lag(k) OVER w AS before, lag(updated) OVER w AS was, coalesce(lead(k) OVER w, n + 1) AS next FROM each WINDOW w AS (PARTITION BY source_id ORDER BY k)),
r AS (SELECT source_id, k, CASE WHEN before IS NULL THEN 'new' WHEN before < k - 1 THEN 'restored' WHEN updated IS DISTINCT FROM was THEN 'content_check' ELSE 'unchanged' END AS state, coalesce(k - before - 1, 0) AS m FROM o
UNION ALL SELECT source_id, g, CASE WHEN g - k >= 2 THEN 'orphan' ELSE 'suspected' END, g - k FROM (SELECT *, unnest(range(k + 1, next)) AS g FROM o))
SELECT s.snapshot_id, source_id, state, CAST(m AS INT) AS missing_scans FROM r JOIN scans s USING (k) WHERE k > 1""",
    "working_set": f"""{_EACH}, g AS (SELECT source_id, max(k) AS k, any_value(n) AS n, arg_max(creator_uid, k) FILTER (trim(creator_uid) <> '') AS creator_uid, arg_max(permission_hash, k) FILTER (trim(permission_hash) <> '') AS permission_hash, max(k) FILTER (k < n) AS ok FROM each GROUP BY 1),
j AS (SELECT g.*, e.file_name, e.source_hash AS sh, e.extracted_hash AS xh, g.k = g.n AND (g.ok IS NULL OR o.updated IS DISTINCT FROM e.updated) AS extract FROM g JOIN each e ON e.source_id = g.source_id AND e.k = g.k LEFT JOIN each o ON o.source_id = g.source_id AND o.k = g.ok)
SELECT source_id, CASE WHEN k = n THEN 'listed' ELSE 'missing' END AS presence, file_name, creator_uid, permission_hash, CASE WHEN NOT extract THEN sh END AS source_hash, CASE WHEN NOT extract THEN xh END AS extracted_hash, extract FROM j""",
    "path_batches": f"{_LAST} SELECT source_id, source_path, CAST((row_number() OVER (ORDER BY source_path NULLS FIRST, source_id) - 1) // 30 AS BIGINT) AS batch FROM last",
    "lowest_share_of_relations": f"WITH {_REL} SELECT relation_id FROM rel QUALIFY row_number() OVER (ORDER BY sha256(relation_id), relation_id) <= greatest(1, ceil(count(*) OVER () * 0.2))",
    "spaced_documents": f"{_EACH}, {_SIZES}, o AS (SELECT source_id, chars, row_number() OVER (ORDER BY chars, source_id) - 1 AS k, count(*) OVER () AS n FROM sizes), p AS (SELECT DISTINCT CAST(round_even(i * (n - 1) / 11.0, 0) AS BIGINT) AS k FROM (SELECT any_value(n) AS n FROM o), range(12) t(i)) SELECT source_id, chars FROM o WHERE k IN (SELECT k FROM p)",
    "content_packs": f"""{_EACH}, {_SIZES}, o AS (SELECT *, row_number() OVER (PARTITION BY department ORDER BY source_id) AS r FROM sizes),
w AS (SELECT source_id, department, chars, r, 0 AS pack, 1 AS items, chars AS total FROM o WHERE r = 1
UNION ALL SELECT o.source_id, o.department, o.chars, o.r, CASE WHEN w.items >= 15 OR w.total + o.chars > 20000 THEN w.pack + 1 ELSE w.pack END, CASE WHEN w.items >= 15 OR w.total + o.chars > 20000 THEN 1 ELSE w.items + 1 END, CASE WHEN w.items >= 15 OR w.total + o.chars > 20000 THEN o.chars ELSE w.total + o.chars END FROM w JOIN o ON o.department = w.department AND o.r = w.r + 1)
SELECT source_id, department, CAST(chars AS BIGINT) AS chars, CAST(pack AS BIGINT) AS pack FROM w""",
    "row_fingerprints": f"{_LAST} SELECT source_id, sha256(CAST(to_json({{'creator_uid': coalesce(creator_uid, ''), 'file_name': coalesce(file_name, ''), 'permission_hash': coalesce(permission_hash, ''), 'source_hash': coalesce(source_hash, ''), 'source_path': coalesce(source_path, '')}}) AS VARCHAR)) AS fingerprint FROM last",
    "plain_urls": f"""WITH {_TEXTS}, p AS (SELECT source_id, content, regexp_extract_all(content, '{messages.URL.replace("'", "''")}') AS l, regexp_split_to_array(content, '{messages.URL.replace("'", "''")}') AS t FROM texts1),
u AS (SELECT source_id, content, t, list_transform(l, lambda x: CASE WHEN regexp_matches(x, '(?i)[?&]({_SIGNED})=') THEN regexp_replace(regexp_replace(x, '{messages.URL_END}', ''), '[?#].*$', '') || regexp_extract(x, '({messages.URL_END[:-1]})$', 1) ELSE x END) AS l FROM p)
SELECT source_id, sha256(array_to_string(list_transform(t, lambda x, i: x || coalesce(l[i], '')), '')) AS text_hash FROM u""",
    "safe_messages": f"WITH {_TEXTS} SELECT source_id, substr(regexp_replace(regexp_replace(content, 'https?://\\S+', '[URL]', 'g'), '{messages.MESSAGE_SECRET}', '\\1=[REDACTED]', 'g'), 1, 1000) AS message FROM texts1",
    "safe_names": """WITH f AS (SELECT DISTINCT file_name, regexp_replace(trim(regexp_replace(file_name, '[\\x00-\\x1f/:]', '_', 'g')), '\\.+$', '') AS t FROM raw_manifest)
SELECT file_name, rtrim(substr(CASE WHEN t = '' THEN '未命名' ELSE t END, 1, 20)) AS safe, substr(replace(trim(regexp_replace(coalesce(file_name, ''), '\\s+', ' ', 'g')), '|', '｜'), 1, 20) AS inline FROM f""",
    "risk_flags": f"SELECT DISTINCT relation_id, unnest(CASE WHEN coalesce(risk_flags, '') = '' THEN [] WHEN NOT json_valid(risk_flags) THEN [risk_flags] ELSE coalesce(TRY_CAST(risk_flags AS JSON)->>'$[*]', []) END) AS flag FROM relation_verification WHERE {strip_sql('relation_id')} <> ''",
    "stale_documents": f"{_EACH} SELECT source_id FROM docs WHERE len(list_filter(list_concat(coalesce(version_signals, []), [coalesce(content, '')]), lambda x: regexp_matches(x, '{messages.STALE}'))) > 0",
    "conflict_signatures": f"""{_LAST}, {_REL}, f AS (SELECT DISTINCT {strip_sql('relation_id')} AS relation_id FROM relation_verification WHERE json_valid(risk_flags) AND list_contains(TRY_CAST(risk_flags AS JSON)->>'$[*]', '冲突') OR risk_flags = '冲突'),
a AS (SELECT source_id AS id, coalesce(extracted_hash, source_hash, '') AS h FROM last), b AS (SELECT source_id AS id, coalesce(extracted_hash, source_hash, '') AS h FROM old)
SELECT rel.relation_id, sha256(concat_ws('|', rel.source_id, coalesce(sa.h, ''), rel.target_id, coalesce(ta.h, ''))) AS signature, NOT coalesce(sa.h = sb.h AND ta.h = tb.h, false) AS is_new
FROM rel JOIN f USING (relation_id) LEFT JOIN a sa ON sa.id = rel.source_id LEFT JOIN a ta ON ta.id = rel.target_id LEFT JOIN b sb ON sb.id = rel.source_id LEFT JOIN b tb ON tb.id = rel.target_id""",
    "unseen_contents": f"{_LAST} SELECT coalesce(extracted_hash, source_hash) AS content_hash, count(*) AS records FROM last WHERE coalesce(extracted_hash, source_hash) IS NOT NULL AND coalesce(extracted_hash, source_hash) NOT IN (SELECT coalesce(extracted_hash, source_hash) FROM each WHERE k < n AND coalesce(extracted_hash, source_hash) IS NOT NULL) GROUP BY 1",
    "longest_names": f"{_LAST} SELECT {_FOLDER} AS folder, arg_min(file_name, (-length(file_name), file_name)) AS file_name FROM last WHERE {_FOLDER} <> '' AND file_name IS NOT NULL GROUP BY 1",
    "change_list": f"{_EACH}{_CHANGES} SELECT snapshot_id, source_id, f[1] AS change_type, row_number() OVER (ORDER BY snapshot_id, list_position({list(incremental.KINDS)}, f[1]), source_id) AS place FROM flagged WHERE f[1] <> 'unchanged'",
    "markdown_titles": f"""WITH {_TEXTS}, h AS (SELECT *, regexp_extract(content, '(?:^|[\\r\\n])(#[ \\t]+[^\\r\\n]+)', 1) AS l, regexp_extract(content, '((?:^|[\\r\\n])#[ \\t]+[^\\r\\n]+)', 1) AS w FROM texts1),
p AS (SELECT *, instr(content, w) + length(w) - length(l) AS a FROM h)
SELECT source_id, CASE WHEN l <> '' THEN trim(regexp_replace(l, '^#[ \\t]+', '')) END AS title, sha256(CASE WHEN l <> '' THEN substr(content, 1, a - 1) || substr(content, a + length(l)) ELSE content END) AS rest_hash FROM p""",
}
