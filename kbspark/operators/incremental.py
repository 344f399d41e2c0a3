"""What a new listing means for the state kept from the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kbspark.plans.skew import small

#: Kinds of change, most pressing first.
KINDS = ("missing", "new", "content_check", "permission_changed", "moved", "renamed", "metadata_changed", "unchanged")


def change_flags(each: DataFrame) -> DataFrame:
    """(snapshot_id, source_id, change_type, flags, needs_extraction) of every record against the scan before.

    ``each`` is ``documents.listing(..., last_only=False)``. A full outer join on record and
    scan; flags: new, missing, content_check (update_time differs as an instant), renamed,
    moved, permission_changed (both hashes given), metadata_changed (a given creator, extension,
    content type or link differs; a missing one is a blind spot and no change). The change
    type is the most pressing flag. The first scan has no rows.
    """
    fields = ("file_name", "source_path", "updated", "creator_uid", "extension", "content_type", "source_url", "permission_hash")
    new = each.select("source_id", "snapshot_id", "is_first", *[F.col(c).alias(f"new_{c}") for c in fields], F.lit(True).alias("here"))
    old = each.select("source_id", F.col("next_snapshot_id").alias("snapshot_id"), *[F.col(c).alias(f"old_{c}") for c in fields], F.lit(True).alias("before"))
    both = new.join(old, ["snapshot_id", "source_id"], "full_outer").where(F.col("snapshot_id").isNotNull() & ~F.coalesce("is_first", F.lit(False)))
    n, o = (lambda c: F.col(f"new_{c}")), (lambda c: F.col(f"old_{c}"))
    blank = lambda c: F.coalesce(F.trim(n(c)), F.lit("")) == ""
    differs = lambda c: ~n(c).eqNullSafe(o(c))
    meta = F.lit(False)
    for c in ("creator_uid", "extension", "content_type", "source_url"):
        meta = meta | (~blank(c) & differs(c))
    flags = F.array_compact(
        F.array(
            F.when(differs("updated"), "content_check"),
            F.when(differs("permission_hash") & n("permission_hash").isNotNull() & o("permission_hash").isNotNull(), "permission_changed"),
            F.when(differs("source_path"), "moved"),
            F.when(differs("file_name"), "renamed"),
            F.when(meta, "metadata_changed"),
        )
    )
    flags = F.when(F.col("here").isNull(), F.array(F.lit("missing"))).when(F.col("before").isNull(), F.array(F.lit("new"))).when(F.size(flags) == 0, F.array(F.lit("unchanged"))).otherwise(flags)
    return both.select("snapshot_id", "source_id", flags.alias("flags")).select(
        "snapshot_id",
        "source_id",
        F.col("flags")[0].alias("change_type"),
        F.array_join("flags", ",").alias("flags"),
        (F.array_contains("flags", "new") | F.array_contains("flags", "content_check")).alias("needs_extraction"),
    )


def missing_runs(each: DataFrame, scans: DataFrame) -> DataFrame:
    """(source_id, last_seen, missing_scans): records gone at the end and since how many complete scans.

    ``scans`` has snapshot_id and scan_no, in order. Counted from the last sight of each
    record, which is what a counter that goes up at each scan and back to 0 at sight holds.
    """
    seen = each.select("source_id", "snapshot_id").join(scans, "snapshot_id").groupBy("source_id").agg(F.max(F.struct("scan_no", "snapshot_id")).alias("last"))
    end = scans.agg(F.max("scan_no").alias("end"))
    return seen.join(F.broadcast(end)).select("source_id", F.col("last.snapshot_id").alias("last_seen"), (F.col("end") - F.col("last.scan_no")).cast("int").alias("missing_scans")).where("missing_scans > 0")


def numbered_scans(snapshots: DataFrame) -> DataFrame:
    """(snapshot_id, scan_no) of the complete scans by time; one row a scan."""
    rows = snapshots.where(F.lower(F.trim("scan_status")) == "complete").groupBy("snapshot_id").agg(F.max("observed_at").alias("at"))
    return rows.select("snapshot_id", F.row_number().over(Window.orderBy("at", "snapshot_id")).alias("scan_no"))


def reclassified(each: DataFrame) -> DataFrame:
    """(snapshot_id, source_id, outcome) of the records whose content was to be checked, by the hashes of text, then of file.

    text differs: content_changed; same text, other file: file_changed_text_unchanged; same
    text: metadata_only; without text hashes the file's decide; without any: unresolved.
    """
    new = each.select("source_id", "snapshot_id", F.col("updated").alias("nu"), F.col("source_hash").alias("ns"), F.col("extracted_hash").alias("nt"))
    old = each.select("source_id", F.col("next_snapshot_id").alias("snapshot_id"), F.col("updated").alias("ou"), F.col("source_hash").alias("os"), F.col("extracted_hash").alias("ot"))
    rows = new.join(old, ["snapshot_id", "source_id"]).where(~F.col("nu").eqNullSafe(F.col("ou")))
    text, file = F.col("nt").isNotNull() & F.col("ot").isNotNull(), F.col("ns").isNotNull() & F.col("os").isNotNull()
    outcome = (
        F.when(text & (F.col("nt") != F.col("ot")), "content_changed")
        .when(text & ~F.col("ns").eqNullSafe(F.col("os")), "file_changed_text_unchanged")
        .when(text, "metadata_only")
        .when(file & (F.col("ns") != F.col("os")), "content_changed")
        .when(file, "metadata_only")
        .otherwise("content_unresolved")
    )
    return rows.select("snapshot_id", "source_id", outcome.alias("outcome"))


def applied_state(rows: DataFrame, scans: DataFrame) -> DataFrame:
    """(source_id, snapshot_id, file_name, source_hash): the state after the last scan; a record that is gone keeps its last row.

    ``rows`` is ``documents.readings``: one aggregate over the rows as delivered, in which the
    scan counts before what decides between repeated readings.
    """
    last = rows.join(small(scans), "snapshot_id").groupBy("source_id").agg(F.max(F.struct("scan_no", "r", "snapshot_id")).alias("s"))
    return last.select("source_id", "s.snapshot_id", "s.r.file_name", "s.r.source_hash")


def change_states(each: DataFrame, scans: DataFrame, confirm: int = 2, audit: bool = False) -> DataFrame:
    """(snapshot_id, source_id, state, missing_scans) of every record known at each scan after the first.

    Missing records: ``suspected`` until they were missing at ``confirm`` scans in a row,
    ``orphan`` from then on. Records that are there: ``new``, ``restored`` (back after
    missing scans, whose number is given), ``content_check`` (update_time differs from the
    last sight, or ``audit`` asks to check all), ``unchanged``. A record has at most one row
    per scan, so that its window is small however often it is delivered.
    """
    own = Window.partitionBy("source_id").orderBy("scan_no")
    end = scans.agg(F.max("scan_no").alias("end"))
    seen = each.select("source_id", "snapshot_id", "updated").join(F.broadcast(scans), "snapshot_id").join(F.broadcast(end))
    seen = seen.select("source_id", "scan_no", "updated", F.lag("scan_no").over(own).alias("before"), F.lag("updated").over(own).alias("was"), F.coalesce(F.lead("scan_no").over(own), F.col("end") + 1).alias("next"))
    check = F.lit(True) if audit else ~F.col("updated").eqNullSafe(F.col("was"))
    state = F.when(F.col("before").isNull(), "new").when(F.col("before") < F.col("scan_no") - 1, "restored").when(check, "content_check").otherwise("unchanged")
    there = F.struct("scan_no", state.alias("state"), F.coalesce(F.col("scan_no") - F.col("before") - 1, F.lit(0)).alias("missing_scans"))
    gone = F.when(
        F.col("next") > F.col("scan_no") + 1,
        F.transform(F.sequence(F.col("scan_no") + 1, F.greatest("next", F.col("scan_no") + 2) - 1), lambda k: F.struct(k.alias("scan_no"), F.when(k - F.col("scan_no") >= max(1, confirm), "orphan").otherwise("suspected").alias("state"), (k - F.col("scan_no")).alias("missing_scans"))),
    )
    rows = seen.select("source_id", F.explode(F.concat(F.array(there), F.coalesce(gone, F.array().cast(gone_type())))).alias("s")).select("source_id", "s.*").where("scan_no > 1")
    return rows.join(F.broadcast(scans), "scan_no").select("snapshot_id", "source_id", "state", F.col("missing_scans").cast("int").alias("missing_scans"))


def gone_type() -> str:
    return "array<struct<scan_no:int,state:string,missing_scans:int>>"


def working_set(each: DataFrame, scans: DataFrame) -> DataFrame:
    """(source_id, presence, file_name, creator_uid, permission_hash, source_hash, extracted_hash, extract) to go on with.

    The last listing; creator and permission stay what they were where it leaves them blank,
    since they come from other lookups; hashes of records that are to be extracted again (new
    or with another update_time) are void. Records that the last listing lacks stay with
    their last row, ``missing``. One aggregate over all listings.
    """
    end = F.broadcast(scans.agg(F.max("scan_no").alias("end")))
    rows = each.join(F.broadcast(scans), "snapshot_id").join(end).withColumn("now", F.col("scan_no") == F.col("end"))
    filled = {c: F.max(F.when(F.trim(c) != "", F.struct("scan_no", F.col(c).alias("v")))).alias(f"k_{c}") for c in ("creator_uid", "permission_hash")}
    fields = F.struct("scan_no", "now", "file_name", "source_hash", "extracted_hash", "updated")
    one = rows.groupBy("source_id").agg(F.max(fields).alias("r"), F.max(F.when(~F.col("now"), F.struct("scan_no", "updated"))).alias("old"), *filled.values())
    extract = F.col("r.now") & (F.col("old").isNull() | ~F.col("old.updated").eqNullSafe(F.col("r.updated")))
    keep = lambda c: F.when(~extract, F.col(f"r.{c}")).alias(c)
    return one.select("source_id", F.when(F.col("r.now"), "listed").otherwise("missing").alias("presence"), "r.file_name", *[F.col(f"k_{c}.v").alias(c) for c in filled], keep("source_hash"), keep("extracted_hash"), extract.alias("extract"))
