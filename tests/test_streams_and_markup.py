import time

import pytest
from pyspark.sql import functions as F

from kbspark.functions import markup
from kbspark.operators import quality
from kbspark.streaming import readings


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("value", "want"),
    [("<p>a&amp;b</p><script>x</script>\n\n<b>c</b>", "a&b\nc"), ("plain", "plain"), ("", ""), (None, None), ("<!-- no -->1 < 2", "1 < 2")],
)
def test_visible_text(spark, value, want):
    got = one(spark, value, markup.visible_text)
    assert (got.strip() if got is not None else None) == want


def test_unsafe_characters(spark):
    assert one(spark, "a​b\tc\n\x07", markup.safe_characters) == "ab\tc\n"
    assert one(spark, "a​b\x07", markup.unsafe_characters) == ["​", "\x07"]


def brute(text, word, before, after):
    out, at = [], text.find(word)
    while at >= 0:
        a, b = max(0, at - before), min(len(text), at + len(word) + after)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
        at = text.find(word, at + len(word))
    return out


@pytest.mark.parametrize("text", ["", "xx", "key", "..key....key............key", "key" * 9 + "." * 30 + "key", "😀key" + "." * 50 + "key😀"])
def test_hit_windows(spark, text):
    got = one(spark, text, lambda c: markup.hit_windows(c, "key", 4, 5))
    assert [tuple(w) for w in got or []] == brute(text, "key", 4, 5)


def test_headings(spark):
    assert one(spark, "# A\r\n## B \r#no\ntext # c\n### D", markup.headings) == ["# A", "## B ", "### D"]


def test_streamed_readings_take_the_latest_in_any_order(spark, tmp_path):
    rows = [(" kb-1", "2026-01-02 00:00:00", "sha256:B"), ("KB-1", "2026-01-01 00:00:00", "a"), (None, "2026-01-01 00:00:00", "x"), ("KB-2", None, None)]
    df = spark.createDataFrame(rows, "source_id string, loaded_at string, source_hash string").withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    df.repartition(3).write.parquet(f"{tmp_path}/raw_manifest.parquet")
    got = {r.source_id: (r.source_hash, r.readings) for r in readings.drained(readings.latest_readings(readings.files(spark, str(tmp_path), "raw_manifest", 1)), "t", "source_id").collect()}
    assert got == {"KB-1": ("b", 2), "KB-2": (None, 1)}


def test_checks_on_empty_tables(spark):
    m = spark.createDataFrame([], "snapshot_id string, source_id string, source_hash string, extension string, creator_uid string, extracted_chars long")
    s = spark.createDataFrame([], "source_id string, content string, summary string, document_key string")
    v = spark.createDataFrame([], "source_id string, target_id string, confidence double, verified_relation_type string")
    rows = quality.table_checks(m, spark.createDataFrame([], "snapshot_id string"), s, v).collect()
    assert len(rows) == 14 and all(r.rows == r.failed == 0 for r in rows)


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    """Batches in the order of the files: within a day an earlier row still counts, later than that it doesn't."""
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    for k, (day, value) in enumerate([("2026-01-10 05:00:00", 1.0), ("2026-01-09 20:00:00", 2.0), ("2026-01-10 04:00:00", 4.0), ("2026-01-01 00:00:00", 8.0)]):
        rows = spark.createDataFrame([(k, day, "view", value)], "event_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
        time.sleep(1.1)  # files are taken in the order of their times
    assert spark.read.parquet(f"{tmp_path}/events.parquet").schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    got = readings.drained(readings.windowed_events(readings.files(spark, str(tmp_path), "events", 1)), "w", "window_start", "event_type").collect()
    assert sorted((str(r.window_start), r.events, r.total) for r in got) == [("2026-01-09 18:00:00", 1, 2.0), ("2026-01-10 00:00:00", 2, 5.0)]
