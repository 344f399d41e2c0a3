"""The tables as streams: state that grows with records, not with readings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kbspark.functions.text import canonical_hash, canonical_id
from kbspark.plans.lineage import shared_folder
from kbspark.sources.files import exists


def drained(stream: DataFrame, tag: str, key: str, *keys: str) -> DataFrame:
    """Run a streaming aggregate by ``key`` and ``keys`` over all that is there and return its final result.

    Every batch adds the groups that it changed, under its number, so that state behind a
    watermark can go; of each group the row of the last batch counts. The checkpoint lies
    beside the result in the shared folder, so that a restarted query goes on where it
    stopped; a batch that is run again replaces what it wrote.
    """
    spark, keys = stream.sparkSession, (key, *keys)
    base = f"{shared_folder(spark)}/kbspark/{tag}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/result/batch={number}")

    query = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if not exists(spark, f"{base}/result"):
        return spark.createDataFrame([], stream.schema)
    rows = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).option("basePath", f"{base}/result").parquet(f"{base}/result")
    return rows.groupBy(*keys).agg(F.max(F.struct("batch", *[c for c in stream.columns if c not in keys])).alias("r")).select(*[c if c in keys else f"r.{c}" for c in stream.columns])


def files(spark: SparkSession, folder: str, name: str, per_batch: int = 100) -> DataFrame:
    """A table of a size folder, one file or a folder of files, as a stream of its files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()
    glob = {} if whole else {"pathGlobFilter": f"{name}.parquet"}
    return spark.readStream.schema(schema).options(maxFilesPerTrigger=per_batch, **glob).parquet(f"{folder}/{name}.parquet" if whole else folder)


def latest_readings(stream: DataFrame) -> DataFrame:
    """(source_id, loaded_at, source_hash, readings) of every record over the whole stream, whatever order its readings come in."""
    rows = stream.select(canonical_id("source_id").alias("source_id"), F.struct("loaded_at", canonical_hash("source_hash").alias("source_hash")).alias("r")).where(F.col("source_id").isNotNull())
    return rows.groupBy("source_id").agg(F.max("r").alias("r"), F.count(F.lit(1)).alias("readings")).select("source_id", "r.loaded_at", "r.source_hash", "readings")


def windowed_events(stream: DataFrame, width: str = "6 hours", late: str = "1 day") -> DataFrame:
    """(window_start, event_type, events, total): events in tumbling windows by event time, behind a watermark."""
    rows = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return rows.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", "total")
