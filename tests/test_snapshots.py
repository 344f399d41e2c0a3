from datetime import datetime

import pytest

from kbspark.operators.snapshots import change_counts, snapshot_changes

MANIFEST = "snapshot_id string, source_id string, loaded_at timestamp, source_hash string, update_time string, extra string"
SNAPSHOTS = "snapshot_id string, observed_at timestamp, scan_status string"
DAYS = [datetime(2026, 1, d) for d in range(1, 10)]


def scans(spark, *rows):
    return spark.createDataFrame([(a, DAYS[d], s) for a, d, s in rows], SNAPSHOTS)


def run(spark, rows, snaps):
    df = spark.createDataFrame([(s, i, DAYS[0] if n is None else DAYS[n], h, u, "x") for s, i, n, h, u in rows], MANIFEST)
    return {tuple(r) for r in snapshot_changes(df, snaps).collect()}


def test_added_removed_changed_and_aborted_scans(spark):
    snaps = scans(spark, ("z", 0, "complete"), ("m", 1, "aborted"), ("a", 2, "complete"))
    rows = [
        ("z", "KB-1", 0, "sha256:AA", "2026-01-01T00:00:00Z"),
        ("z", "KB-2", 0, "bb", "2026-01-01T00:00:00Z"),
        ("z", "KB-3", 0, "cc", "2026-01-01T00:00:00Z"),
        ("m", "KB-9", 1, "dd", "2026-01-01T00:00:00Z"),
        ("a", " kb-1 ", 2, "aa ", "2026-01-05T00:00:00Z"),
        ("a", "KB-3", 2, "ce", "2026-01-01T00:00:00Z"),
        ("a", "KB-4", 2, "dd", "2026-01-01T00:00:00Z"),
        ("a", None, 2, "dd", "2026-01-01T00:00:00Z"),
        ("a", "  ", 2, "dd", "2026-01-01T00:00:00Z"),
    ]
    assert run(spark, rows, snaps) == {("a", "KB-2", "removed"), ("a", "KB-3", "changed"), ("a", "KB-4", "added")}


@pytest.mark.parametrize(
    ("old", "new", "changed"),
    [
        ("2026-01-01T08:00:00+08:00", "2026-01-01T00:00:00Z", False),
        ("2026-01-01T00:00:00", "1767225600", False),
        ("1767225600000", "2026-01-01T00:00:00Z", False),
        ("1767225600000", "2026-01-01T00:00:01Z", True),
        (None, None, False),
        ("", "2026-01-01T00:00:00Z", True),
    ],
)
def test_instants_decide_where_a_hash_is_missing(spark, old, new, changed):
    snaps = scans(spark, ("s1", 0, "complete"), ("s2", 1, "complete"))
    got = run(spark, [("s1", "K", 0, None, old), ("s2", "K", 1, "aa", new)], snaps)
    assert got == ({("s2", "K", "changed")} if changed else set())


def test_latest_loading_counts_and_ties_are_decided(spark):
    snaps = scans(spark, ("s1", 0, "complete"), ("s2", 1, "complete"))
    rows = [("s1", "K", 3, "aa", "x"), ("s1", "K", 1, "bb", "x"), ("s2", "K", 2, "aa", "x"), ("s2", "K", 2, "aa", "x"), ("s2", "K", 1, "cc", "x")]
    assert run(spark, rows, snaps) == set()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SNAPSHOTS)
    assert run(spark, [("s1", "K", 0, "a", "1")], none) == set()
    empty = spark.createDataFrame([], MANIFEST)
    assert change_counts(snapshot_changes(empty, scans(spark, ("s1", 0, "complete"), ("s2", 1, "complete")))).count() == 0
