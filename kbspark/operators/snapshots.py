"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kbspark.functions.text import canonical_hash, canonical_id, canonical_word
from kbspark.functions.times import instant_micros
from kbspark.plans.skew import small


def complete_scans(snapshots: DataFrame) -> DataFrame:
    """(snapshot_id, next_snapshot_id, is_first) of the complete scans in order of observed_at.

    The table has one row per scan, not per record, so that one window over it is small.
    Aborted scans, scans without time and repeated rows of a scan are left out; ties in time
    go by id.
    """
    scans = (
        snapshots.where(canonical_word("scan_status") == "complete")
        .where(F.col("snapshot_id").isNotNull() & F.col("observed_at").isNotNull())
        .groupBy("snapshot_id")
        .agg(F.max("observed_at").alias("observed_at"))
    )
    order = Window.orderBy("observed_at", "snapshot_id")
    return scans.select(
        "snapshot_id",
        F.lead("snapshot_id").over(order).alias("next_snapshot_id"),
        F.lag("snapshot_id").over(order).isNull().alias("is_first"),
    )


def current_rows(manifest: DataFrame, scans: DataFrame) -> DataFrame:
    """One row per record and complete scan: of repeated readings the one loaded last.

    Columns: snapshot_id, next_snapshot_id, is_first, source_id, content (canonical hash,
    null where missing), updated (instant in microseconds). Rows without id are ignored. Of
    readings loaded at the same time the greatest (content, updated) counts. The readings
    of one record meet in a partial aggregate before the shuffle.
    """
    rows = manifest.select(
        "snapshot_id",
        canonical_id("source_id").alias("source_id"),
        "loaded_at",
        F.unhex(canonical_hash("source_hash")).alias("as_bytes"),
        canonical_hash("source_hash").alias("as_text"),
        instant_micros("update_time").alias("updated"),
    ).where(F.col("source_id").isNotNull())
    # a hash that is no hex text keeps its letters
    content = F.coalesce("as_bytes", F.encode("as_text", "UTF-8"))
    return (
        rows.join(small(scans), "snapshot_id")
        .groupBy("source_id", "snapshot_id", "next_snapshot_id", "is_first")
        .agg(F.max(F.struct("loaded_at", content.alias("content"), "updated")).alias("r"))
        .select("source_id", "snapshot_id", "next_snapshot_id", "is_first", "r.content", "r.updated")
    )


def row_hash(*parts: str) -> F.Column:
    """128-bit hash of the canonical spelling of a row's fields; null where any is missing."""
    return F.unhex(F.md5(F.concat(*[x for p in parts for x in (F.lit("\x1f"), F.col(p))])))


def snapshot_changes(manifest: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(snapshot_id, source_id, change_type) for every two consecutive complete snapshots.

    A full outer join on record and scan: the earlier listing, moved on to the scan after
    it, against the later one, each row as the canonical hashes of what decides: of its
    content and, where that is missing in either, of the instant of its update_time. A side
    that is missing gives ``added`` or ``removed``; a record in both is ``changed`` if the
    hashes that decide differ (one missing instant differs from a present one, two missing
    ones don't). Fewer than two complete scans or an empty manifest give no rows.
    """
    rows = current_rows(manifest, complete_scans(snapshots)).withColumn("updated", F.encode(F.col("updated").cast("string"), "UTF-8"))
    hashed = rows.select("snapshot_id", "next_snapshot_id", "source_id", "is_first", row_hash("content").alias("by_content"), row_hash("updated").alias("by_time"))
    later = hashed.select("snapshot_id", "source_id", "is_first", F.struct("by_content", "by_time").alias("new"))
    earlier = hashed.select(F.col("next_snapshot_id").alias("snapshot_id"), "source_id", F.struct("by_content", "by_time").alias("old"))
    both = later.join(earlier, ["snapshot_id", "source_id"], "full_outer")
    differs = F.when(F.col("new.by_content").isNotNull() & F.col("old.by_content").isNotNull(), F.col("new.by_content") != F.col("old.by_content")).otherwise(~F.col("new.by_time").eqNullSafe(F.col("old.by_time")))
    change = F.when(F.col("old").isNull(), F.when(~F.col("is_first"), "added")).when(F.col("new").isNull(), "removed").when(differs, "changed")
    return both.where(F.col("snapshot_id").isNotNull()).select("snapshot_id", "source_id", change.alias("change_type")).where(F.col("change_type").isNotNull())


def change_counts(changes: DataFrame) -> DataFrame:
    """Rows per snapshot and change type."""
    return changes.groupBy("snapshot_id", "change_type").agg(F.count(F.lit(1)).alias("records"))
