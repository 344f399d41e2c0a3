"""The tree of folders, and reports over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ancestors(path) -> F.Column:
    """All folders above a path, the nearest last."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def folder_index(docs: DataFrame) -> DataFrame:
    """(folder, depth, documents, folders, all_documents) of every folder on the way to a document.

    Direct documents and folders, and all documents below; counts combine before the
    shuffle, so that a folder with a third of all documents is one row per task.
    """
    inside = docs.where(F.contains(F.col("source_path"), F.lit("/"))).select("source_id", "source_path", ancestors(F.col("source_path")).alias("up"))
    below = inside.select(F.posexplode("up").alias("i", "folder"), (F.col("i") == F.size("up") - 1).alias("direct"))
    counts = below.groupBy("folder").agg(F.count_if("direct").alias("documents"), F.count(F.lit(1)).alias("all_documents"))
    parents = below.select("folder").distinct().where(F.contains(F.col("folder"), F.lit("/"))).select(F.regexp_extract("folder", r"^(.*)/[^/]*$", 1).alias("folder"))
    children = parents.groupBy("folder").agg(F.count(F.lit(1)).alias("folders"))
    depth = F.size(F.split("folder", "/"))
    return counts.join(children, "folder", "left").select("folder", depth.alias("depth"), "documents", F.coalesce("folders", F.lit(0)).alias("folders"), "all_documents")


def top_per_folder(docs: DataFrame, most: int = 3) -> DataFrame:
    """(department, rank, source_id, updated): the documents updated last in each department."""
    rows = docs.select(F.split_part("source_path", F.lit("/"), F.lit(1)).alias("department"), "source_id", "updated").where(F.col("updated").isNotNull())
    order = Window.partitionBy("department").orderBy(F.desc("updated"), "source_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("department", "rank", "source_id", "updated")


def hash_number(key: str) -> F.Column:
    """A number from 0 to 2^32 - 1 that the key alone decides."""
    return F.conv(F.substring(F.sha2(F.col(key), 256), 1, 8), 16, 10).cast("bigint")


def hash_sample(rows: DataFrame, key: str, rate: float) -> DataFrame:
    """The rows whose key's hash is among the lowest ``rate`` of all possible: the same ones each time, about that share."""
    bound = int(max(0.0, min(1.0, rate)) * (1 << 32))
    return rows.where(hash_number(key) < bound)


def creator_report(docs: DataFrame) -> DataFrame:
    """(creator_uid, documents, folders, last_updated); a blank creator is null."""
    creator = F.when(F.trim("creator_uid") != "", F.trim("creator_uid"))
    return docs.groupBy(creator.alias("creator_uid")).agg(F.count(F.lit(1)).alias("documents"), F.count_distinct(F.regexp_extract("source_path", r"^(.*)/[^/]*$", 1)).alias("folders"), F.max("updated").alias("last_updated"))


def length_report(docs: DataFrame) -> DataFrame:
    """(extension, documents, without_length, wrong_length): what extracted_chars says against the content."""
    n = F.length("content")
    return docs.where(F.col("content").isNotNull()).groupBy("extension").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.coalesce("extracted_chars", F.lit(0)) == 0).alias("without_length"), F.count_if((F.coalesce("extracted_chars", F.lit(0)) != 0) & (F.col("extracted_chars") != n)).alias("wrong_length")
    )


def batches(docs: DataFrame, most_chars: int = 20_000, groups: int = 1 << 10) -> DataFrame:
    """(source_id, lane, batch, chars): contents packed for a service that takes ``most_chars`` at a time.

    Documents fall into lanes by hash, so that no order over all of them is needed; within a
    lane a batch ends where the running sum of sizes passes a multiple of the limit. A batch
    holds less than the limit plus its last document.
    """
    rows = docs.where(F.col("content").isNotNull()).select("source_id", F.length("content").alias("chars"), F.pmod(hash_number("source_id"), F.lit(groups)).cast("int").alias("lane"))
    run = F.sum("chars").over(Window.partitionBy("lane").orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1))
    return rows.select("source_id", "lane", F.floor(F.coalesce(run, F.lit(0)) / most_chars).cast("int").alias("batch"), F.col("chars").cast("bigint").alias("chars"))
