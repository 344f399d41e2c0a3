"""Numbers, batches and samples along an order of all rows, without one task that holds them all."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kbspark.plans.lineage import cut


def numbered(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` with ``n``, the place of each row from 1 in the order, which has no ties.

    Rows are sorted in ranges, numbered within each range, and moved on by the sizes of the
    ranges before; one row per range reaches one task.
    """
    ranges = cut(df.orderBy(*order).withColumn("range", F.spark_partition_id()), "ranges")
    before = F.coalesce(F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("rows")).select("range", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return ranges.join(F.broadcast(sizes), "range").withColumn("n", (own + F.col("before")).cast("bigint")).drop("range", "before")


def batches_of(df: DataFrame, size: int, *order: Column | str) -> DataFrame:
    """``df`` with ``batch``, from 0: every ``size`` rows of the order are one."""
    return numbered(df, *order).withColumn("batch", F.floor((F.col("n") - 1) / size)).drop("n")


def lowest_share(df: DataFrame, key: str, rate: float) -> DataFrame:
    """The ceil(rows * rate) rows, at least one, whose keys have the lowest hashes; none for a rate of 0. Keys are distinct."""
    rate = max(0.0, min(1.0, rate))
    if rate == 0:
        return df.limit(0)
    most = df.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * rate)).alias("most"))
    return numbered(df, F.sha2(F.col(key), 256), key).join(F.broadcast(most)).where("n <= most").drop("n", "most")


def spaced(df: DataFrame, picks: int, *order: Column | str) -> DataFrame:
    """``picks`` rows evenly spaced along the order, the first and the last among them; the middle one for one pick."""
    if picks <= 0:
        return df
    rows = numbered(df, *order)
    last = F.col("rows") - 1
    steps = rows.agg(F.count(F.lit(1)).alias("rows")).where("rows > 0")
    at = F.floor(F.col("rows") / 2) if picks == 1 else F.bround(F.col("i") * last / (picks - 1))
    places = steps.select("rows", F.explode(F.sequence(F.lit(0), F.lit(picks - 1))).alias("i")).select((at.cast("bigint") + 1).alias("n")).distinct()
    return rows.join(F.broadcast(places), "n", "left_semi").drop("n")


def packed(df: DataFrame, lane: str, size: str, most_items: int, most_size: int, *order: str) -> DataFrame:
    """``df`` with ``pack``, from 0 in each lane: rows in order, as many to a pack as fit both limits; what is larger alone has a pack of its own.

    A lane is gone through in order, row by row, by the task it falls to, which keeps the
    open pack only; lanes should be many.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pack, items, total = object(), 0, 0, 0
        for b in batches:
            out = []
            for own, n in zip(b.column(b.schema.get_field_index(lane)).to_pylist(), b.column(b.schema.get_field_index(size)).to_pylist()):
                n = n or 0
                if own != now:
                    now, pack, items, total = own, 0, 0, 0
                elif items and (items >= most_items or total + n > most_size):
                    pack, items, total = pack + 1, 0, 0
                items, total = items + 1, total + n
                out.append(pack)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], names=[*b.schema.names, "pack"])

    return df.repartition(lane).sortWithinPartitions(lane, *order).mapInArrow(run, ", ".join(f"`{k}` {v}" for k, v in kinds.items()) + ", pack bigint")
