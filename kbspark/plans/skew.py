"""Joins that hold when one key owns a third of the rows, and broadcasts of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small(df: DataFrame, most_rows: int = 10_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most_rows`` rows, else as it is (a shuffle join then)."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def hot_keys(df: DataFrame, key: str, share: float = 0.001, least: int = 20_000) -> DataFrame:
    """Keys that own more than ``share`` of the rows and more than ``least``; at most 1/share of them exist."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg((F.count(F.lit(1)) * share).cast("long").alias("_floor"))
    return counts.join(F.broadcast(total), F.col("_n") > F.greatest("_floor", F.lit(least))).select(key)


def lookup(facts: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``facts`` with ``table`` (unique on the text ``key``), hot keys apart.

    The rows of ``table`` for hot keys number at most 1/share and are broadcast to the facts;
    in the shuffle join that finds the others, facts with a hot key stand under made-up keys
    that spread them evenly and match nothing. No fact is lost or doubled, and ``facts`` is
    worked out twice: to count its keys and to join it.
    """
    rest = [c for c in table.columns if c != key]
    known = table.select(key, F.struct(*rest).alias("_found"))
    hot = F.broadcast(known.join(F.broadcast(hot_keys(facts, key)), key, "left_semi").withColumnRenamed("_found", "_hot"))
    apart = F.concat(F.lit("\0"), F.xxhash64(*facts.columns).cast("string"))
    marked = facts.join(hot, key, "left").withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(apart))
    both = marked.join(known.withColumnRenamed(key, "_key"), "_key", "left").withColumn("_row", F.coalesce("_hot", "_found"))
    if how == "inner":
        both = both.where(F.col("_row").isNotNull())
    return both.select(*facts.columns, *[F.col(f"_row.{c}").alias(c) for c in rest])
