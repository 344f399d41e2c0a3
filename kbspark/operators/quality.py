"""Checks and reports over the tables as they are delivered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbspark.functions.text import blank_to_null, canonical_extension, canonical_hash, canonical_id, canonical_word
from kbspark.plans.skew import small


def table_checks(manifest: DataFrame, snapshots: DataFrame, semantic: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(name, rows, failed): for each rule how many rows it looked at and how many break it. One scan of a table per group of rules."""

    def counted(df: DataFrame, rules: dict[str, F.Column]) -> DataFrame:
        one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
        return one.select("rows", F.explode(F.create_map(*[x for name in rules for x in (F.lit(name), F.col(name))])).alias("name", "failed")).select("name", "rows", "failed")

    m = counted(
        manifest,
        {
            "manifest id given": canonical_id("source_id").isNotNull(),
            "manifest id canonical": F.col("source_id").rlike(r"^KB-[0-9A-F]{12}$"),
            "manifest hash is sha256": canonical_hash("source_hash").rlike(r"^[0-9a-f]{64}$"),
            "manifest extension plain": F.col("extension") == canonical_extension("extension"),
            "manifest creator given": blank_to_null("creator_uid").isNotNull(),
            "manifest length given": F.col("extracted_chars") > 0,
        },
    )
    s = counted(semantic, {"content given": blank_to_null("content").isNotNull(), "summary given": blank_to_null("summary").isNotNull(), "content key fits": F.sha2(F.coalesce("content", F.lit("")), 256) == F.col("document_key")})
    v = counted(
        verdicts,
        {
            "verdict ends given": canonical_id("source_id").isNotNull() & canonical_id("target_id").isNotNull(),
            "verdict ends differ": canonical_id("source_id") != canonical_id("target_id"),
            "verdict confidence in range": F.col("confidence").between(0, 1),
            "verdict type given": blank_to_null("verified_relation_type").isNotNull(),
        },
    )
    known = manifest.join(small(snapshots.select("snapshot_id").distinct()), "snapshot_id", "left_anti").agg(F.count(F.lit(1)).alias("failed"))
    scans = manifest.agg(F.count(F.lit(1)).alias("rows")).join(F.broadcast(known)).select(F.lit("manifest scan known").alias("name"), "rows", "failed")
    return reduce(DataFrame.unionByName, [m, s, v, scans])


def dangling_ends(verdicts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(source_id, verdicts): ids at either end of verdicts that no listing has."""
    ends = verdicts.select(F.explode(F.array(canonical_id("source_id"), canonical_id("target_id"))).alias("source_id")).where(F.col("source_id").isNotNull())
    used = ends.groupBy("source_id").agg(F.count(F.lit(1)).alias("verdicts"))
    return used.join(manifest.select(canonical_id("source_id").alias("source_id")), "source_id", "left_anti")


def verdict_history(verdicts: DataFrame) -> DataFrame:
    """(relation_id, verdicts, first_status, last_status, changed) of every relation."""
    rows = verdicts.where(blank_to_null("relation_id").isNotNull()).select("relation_id", F.struct("verified_at", canonical_word("verification_status").alias("status")).alias("v")).distinct()
    one = rows.groupBy("relation_id").agg(F.count(F.lit(1)).alias("verdicts"), F.min("v").alias("a"), F.max("v").alias("b"))
    return one.select("relation_id", "verdicts", F.col("a.status").alias("first_status"), F.col("b.status").alias("last_status"), (~F.col("a.status").eqNullSafe(F.col("b.status"))).alias("changed"))


def rule_counts(verdicts: DataFrame) -> DataFrame:
    """(rule, status, relations): relations by each of their rules and status."""
    rows = verdicts.select("relation_id", canonical_word("verification_status").alias("status"), F.explode(F.split("rule_ids", "/")).alias("rule")).distinct()
    return rows.groupBy("rule", "status").agg(F.count(F.lit(1)).alias("relations"))


def creator_names(manifest: DataFrame) -> DataFrame:
    """(creator_uid, creator_name, spellings): the name each creator had last, also where later rows leave it blank."""
    rows = manifest.select(blank_to_null("creator_uid").alias("creator_uid"), blank_to_null("creator_name").alias("name"), "loaded_at").where("creator_uid is not null")
    return rows.groupBy("creator_uid").agg(F.max(F.when(F.col("name").isNotNull(), F.struct("loaded_at", "name"))).alias("last"), F.count_distinct("name").alias("spellings")).select("creator_uid", F.col("last.name").alias("creator_name"), "spellings")


def parse_report(manifest: DataFrame) -> DataFrame:
    """(snapshot_id, rows, parsed, failed, pending, other): how far each listing was read; the parts add up to the rows."""
    s = F.trim("parse_status")
    kinds = {"parsed": "全文已解析", "failed": "失败已登记", "pending": "待解析"}
    return manifest.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(s == v).alias(k) for k, v in kinds.items()], F.count_if(~F.coalesce(s.isin(*kinds.values()), F.lit(False))).alias("other"))


def parse_failures(manifest: DataFrame) -> DataFrame:
    """(parse_status, extension, rows, records) of what was not read in full."""
    status = F.trim("parse_status")
    rows = manifest.where(~F.coalesce(status == "全文已解析", F.lit(False)))
    return rows.groupBy(status.alias("parse_status"), canonical_extension("extension").alias("extension")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(canonical_id("source_id")).alias("records"))
