import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kbspark.plans import lineage
from kbspark.plans.lineage import cut, drop_cut, shared_folder
from kbspark.sources import files

SCHEMA = StructType().add("a", "string").add("b", "string").add("n", "long")


@pytest.mark.parametrize("kind", ["csv", "jsonl", "parquet", "orc"])
def test_round_trips(spark, kind):
    rows = [("x,\"y\"\n2\r\n3", "", 1), (None, "\\", None), ("中文😀", " lead ", -5), ("", None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(repr, files.round_trip(df, kind).collect())) == sorted(map(repr, df.collect()))


def test_missing_paths_and_fields(spark, tmp_path):
    assert files.read_rows(spark, f"file://{tmp_path}/none", SCHEMA, "json").count() == 0
    (tmp_path / "m.json").write_text('[{"a": "1", "extra": 2}, {"b": "2", "n": 3}]')
    assert [tuple(r) for r in files.read_rows(spark, f"file://{tmp_path}/m.json", SCHEMA, "json").collect()] == [("1", None, None), (None, "2", 3)]


def test_fixed_columns_and_append(spark, tmp_path):
    df = files.fixed_columns(spark.createDataFrame([("1", 2)], "n string, other int"), SCHEMA)
    assert [tuple(r) for r in df.collect()] == [(None, None, 1)]
    for _ in range(2):
        files.write_rows(df, f"file://{tmp_path}/log", "jsonl", append=True)
    assert files.read_rows(spark, f"file://{tmp_path}/log", SCHEMA, "jsonl").count() == 2


def test_texts_and_signatures(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "KB-1.txt").write_text("one\ntwo")
    assert [tuple(r) for r in files.read_texts(spark, f"file://{tmp_path}/t").collect()] == [("KB-1", "one\ntwo")]
    b = tmp_path / "b"
    b.mkdir()
    (b / "x.pdf").write_bytes(b"%PDF-1.7 ...")
    (b / "y.pdf").write_bytes(b"<html>")
    (b / "z.docx").write_bytes(b"PK\x03\x04abc")
    (b / "t.txt").write_bytes(b"hi")
    assert {r.source_id: r.valid for r in files.read_binaries(spark, f"file://{b}").collect()} == {"x": True, "y": False, "z": True, "t": True}
    df = spark.createDataFrame([(b"a\x00b",), ("é".encode(),)], "c binary").select(files.decoded(F.col("c")).alias("t"))
    assert [r.t for r in df.collect()] == [None, "é"]


def test_cut_tables_are_dropped_and_others_left(spark, tmp_path, monkeypatch):
    own = f"{tmp_path}/own"
    spark.range(3).write.parquet(own)
    for folder in (f"{tmp_path}/shared", f"file://{tmp_path}/shared"):
        monkeypatch.setattr(lineage, "shared_folder", lambda _, folder=folder: folder)
        a, b = cut(spark.range(5), "a"), cut(spark.range(6), "b")
        drop_cut(a, spark.read.parquet(own))
        assert [p.name[:2] for p in (tmp_path / "shared/kbspark").iterdir()] == ["b-"]
        assert b.count() == 6 and spark.read.parquet(own).count() == 3
        drop_cut(b)


def test_no_private_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(dict)

    class Session:
        conf, sparkContext = {}, Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)
