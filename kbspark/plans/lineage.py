"""Cutting lineage with tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; one of our own only where none is set and all executors are on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/")


@lru_cache(1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and go on from the written table, so that a lost executor costs a reread only."""
    path = f"{shared_folder(df.sparkSession)}/kbspark/{tag}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_by(df: DataFrame, key: str, tag: str) -> str:
    """The folder ``df`` was written to, one folder within it for each value of ``key``, for tasks that read some of them on their own."""
    path = f"{shared_folder(df.sparkSession)}/kbspark/{tag}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "zstd").partitionBy(key).parquet(path)
    return path


def files_in_order(df: DataFrame) -> list[str]:
    """The files of a table that ``cut`` wrote, in the order of its partitions."""
    return sorted(df.inputFiles(), key=lambda f: f.rpartition("/")[2])


def batches_of_files(files: list[str], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The rows of files in the shared folder one batch after the other, for a task that reads them on its own."""
    for f in files:
        where, path = fs.FileSystem.from_uri(f)
        with where.open_input_file(path) as opened:
            yield from pq.ParquetFile(opened).iter_batches(rows)


def drop_cut(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote and that no later step reads; what else a DataFrame reads is left alone."""
    for df in tables:
        spark = df.sparkSession
        ours = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/kbspark")
        files = ours.getFileSystem(spark._jsc.hadoopConfiguration())
        root = files.makeQualified(ours).toUri().getPath()
        for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
            folder = spark._jvm.org.apache.hadoop.fs.Path(name)
            if folder.getParent().toUri().getPath() == root:
                files.delete(folder, True)
