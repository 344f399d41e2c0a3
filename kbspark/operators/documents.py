"""The current documents: the last complete listing with its contents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbspark.functions.text import blank_to_null, canonical_extension, canonical_hash, canonical_id
from kbspark.functions.times import instant_micros
from kbspark.operators.snapshots import complete_scans
from kbspark.plans.skew import small

_FIELDS = ("file_name", "source_path", "node_id", "parent_node_id", "source_url", "content_type", "creator_uid", "permission_hash")


def readings(manifest: DataFrame) -> DataFrame:
    """(snapshot_id, source_id, r) of the rows with an id; ``r`` is the row with canonical fields, of which the greatest counts: the one loaded last."""
    rows = manifest.select(
        "snapshot_id",
        canonical_id("source_id").alias("source_id"),
        F.struct(
            "loaded_at",
            *_FIELDS,
            canonical_extension("extension").alias("extension"),
            instant_micros("update_time").alias("updated"),
            canonical_hash("source_hash").alias("source_hash"),
            canonical_hash("extracted_hash").alias("extracted_hash"),
            "extracted_chars",
        ).alias("r"),
    )
    return rows.where(F.col("source_id").isNotNull())


def listing(manifest: DataFrame, snapshots: DataFrame, last_only: bool = True) -> DataFrame:
    """One row per record of the last complete scan (or of each), of repeated readings the one loaded last.

    Canonical id, extension and hashes; update_time as an instant in microseconds. Ties go to
    the greatest row. Partial aggregates meet before the shuffle, so that a record that is
    repeated often makes no large group.
    """
    scans = complete_scans(snapshots)
    if last_only:
        scans = scans.where(F.col("next_snapshot_id").isNull())
        # rows of other scans need no canonical fields
        manifest = manifest.join(small(scans.select("snapshot_id")), "snapshot_id", "left_semi")
    return readings(manifest).join(small(scans), "snapshot_id").groupBy("source_id", "snapshot_id", "next_snapshot_id", "is_first").agg(F.max("r").alias("r")).select("source_id", "snapshot_id", "next_snapshot_id", "is_first", "r.*")


def contents(semantic: DataFrame) -> DataFrame:
    """One row per record with content and profile, the one generated last."""
    fields = ["content", "summary", "page_type_candidate", "document_role", "core_theme", "keywords", "business_objects", "inputs", "outputs", "version_signals", "explicit_references"]
    rows = semantic.select(canonical_id("source_id").alias("source_id"), F.struct("generated_at", *fields).alias("r")).where(F.col("source_id").isNotNull())
    return rows.groupBy("source_id").agg(F.max("r").alias("r")).select("source_id", *[F.col(f"r.{c}").alias(c) for c in fields])


def documents(manifest: DataFrame, snapshots: DataFrame, semantic: DataFrame) -> DataFrame:
    """The listing of the last complete scan with content and profile where there are any."""
    return listing(manifest, snapshots).drop("next_snapshot_id", "is_first").join(contents(semantic), "source_id", "left")


def parent_folder(path) -> F.Column:
    """The folder of a path; null for a file at the root."""
    return blank_to_null(F.regexp_extract(path, r"^(.*)/[^/]*$", 1))
