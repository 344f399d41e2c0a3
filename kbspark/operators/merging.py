"""Merge of what rules say of pairs of documents, in pairs of blocks of documents, so that no pair is shuffled and every bucket is whole.

A bucket of n documents says something of n(n - 1)/2 pairs, and most pairs share one bucket
only. The rows of the rules, one per document and bucket, are written by blocks of documents
to the shared folder; the task of two blocks reads both, marks their pairs in a table of bits
and returns each pair once. What is held depends on the size of a block alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbspark.operators.neighbours import _ranges, pairs_of_blocks
from kbspark.operators.order import numbered
from kbspark.plans.lineage import cut, cut_by, drop_cut
from kbspark.plans.skew import lookup

#: Documents in a block.
SIDE = 2048
#: Pairs that are marked at once, or those of one bucket of two blocks.
PAIRS = 1 << 20
_KEYS = pa.schema([("bit", pa.int32()), ("key", pa.int64()), ("n", pa.int32()), ("give", pa.int32()), ("take", pa.int32())])
_LINKS = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("bit", pa.int32()), ("cosine", pa.float64())])
_NAMES = pa.schema([("n", pa.int32()), ("source_id", pa.string())])

#: (block of sources, block of targets, places of both in their blocks, bits, cosine or NaN)
Found = tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _rows(folder: str, block: int, schema: pa.Schema) -> pa.Table:
    """The rows of a block that ``cut_by`` wrote."""
    files, root = fs.FileSystem.from_uri(f"{folder}/own={block}")
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    tables = [pq.ParquetFile(files.open_input_file(x.path)).read() for x in found if x.base_name.endswith(".parquet")]
    return pa.concat_tables([schema.empty_table(), *(t.select(schema.names).cast(schema) for t in tables)])


class _Rule:
    """Rows of one rule in a block, ordered by their buckets: places of documents, and what each gives and takes."""

    def __init__(self, key: np.ndarray, at: np.ndarray, give: np.ndarray, take: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.keys, self.start, self.size = np.unique(key[order], return_index=True, return_counts=True)
        self.at, self.give, self.take = at[order], give[order], take[order]


class _Side:
    """The rules of the documents of one block, by their bits."""

    def __init__(self, folder: str, block: int, side: int):
        self.block = block
        bit, key, n, give, take = (c.to_numpy() for c in _rows(folder, block, _KEYS).columns)
        at = n.astype(np.int64) - block * side
        self.rules = {int(b): _Rule(key[own], at[own], give[own], take[own]) for b in np.unique(bit) for own in [bit == b]}


class _Marks:
    """Bits of the pairs of two blocks, and the pairs that have any."""

    def __init__(self, side: int):
        self.bits, self.found = np.zeros(side * side, np.uint16), []

    def add(self, pairs: np.ndarray, bit: int) -> None:
        new = pairs[self.bits[pairs] == 0]
        if len(new):
            self.found.append(np.unique(new))
        # a pair that is there twice gets the same bits twice
        self.bits[pairs] |= np.uint16(bit)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs, in order, and their bits; none is marked after that."""
        pairs = np.sort(np.concatenate([np.empty(0, np.int64), *self.found]))
        bits = self.bits[pairs]
        self.bits[pairs], self.found = 0, []
        return pairs, bits


def _met(left: _Rule, right: _Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of both that have a bucket in common."""
    _, i, j = np.intersect1d(left.keys, right.keys, assume_unique=True, return_indices=True)
    ends = np.cumsum(left.size[i] * right.size[j])
    a = 0
    while a < len(i):
        e = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, side="right")))
        many, rows = left.size[i[a:e]], _ranges(left.start[i[a:e]], left.size[i[a:e]])
        k = np.repeat(right.size[j[a:e]], many)
        yield np.repeat(rows, k), _ranges(np.repeat(right.start[j[a:e]], many), k)
        a = e


def _of_two(low: _Side, high: _Side, links: tuple[np.ndarray, ...], directed: int, marks: _Marks, side: int) -> Iterator[Found]:
    """The pairs of two blocks of sources in the lower and targets in the higher one, and, if they are two, the other way round."""
    same = low.block == high.block
    for left, right in ((low, high), (high, low))[: 2 - same]:
        for bit in left.rules.keys() & right.rules.keys():
            both_ways = bool(bit & directed)
            # what has no direction has the smaller document first
            if left.block > right.block and not both_ways:
                continue
            one, other = left.rules[bit], right.rules[bit]
            for x, y in _met(one, other):
                a, b = one.at[x], other.at[y]
                good = (one.give[x] & other.take[y]) != 0
                if same:
                    good &= (a != b) if both_ways else (a < b)
                marks.add(a[good] * side + b[good], bit)
        a, b, bit, cosine = links
        own = (a // side == left.block) & (b // side == right.block)
        pair, bit, cosine = a[own] % side * side + b[own] % side, bit[own], cosine[own]
        for x in np.unique(bit):
            marks.add(pair[bit == x], int(x))
        pairs, bits = marks.taken()
        best = np.full(len(pairs), np.nan)
        near = ~np.isnan(cosine)
        best[np.searchsorted(pairs, pair[near])] = cosine[near]
        yield left.block, right.block, *np.divmod(pairs, side), bits, best


@dataclass(frozen=True)
class Blocks:
    """Rules, links and names of documents, written by blocks of them; a block's folder is named by its number."""

    spark: SparkSession
    ids: DataFrame
    keys: str
    links: str
    names: str
    blocks: int
    side: int
    directed: int

    def _run(self, each: Callable[[Iterator[Found]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """``each`` of the pairs of every pair of blocks."""
        keys, links, side, directed, tasks = self.keys, self.links, self.side, self.directed, pairs_of_blocks(self.blocks)

        def found(k: int) -> Iterator[Found]:
            i, others = tasks[k]
            one, marks = _Side(keys, i, side), _Marks(side)
            own = None
            for j in others:
                low, high = sorted((one, one if i == j else _Side(keys, j, side)), key=lambda s: s.block)
                if low is not one:
                    here = _arrays(links, low.block)
                else:
                    here = own = _arrays(links, i) if own is None else own
                yield from _of_two(low, high, here, directed, marks, side)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column("id").to_pylist():
                    yield from each(found(k))

        return self.spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(run, schema)

    def edges(self) -> DataFrame:
        """(source_id, target_id, bits, cosine) of every pair of which any rule says something."""
        folder = self.names

        def each(found: Iterator[Found]) -> Iterator[pa.RecordBatch]:
            names: dict[int, pa.Array] = {}
            for i, j, a, b, bits, cosine in found:
                names = {k: names[k] if k in names else _rows(folder, k, _NAMES).sort_by("n").column("source_id").combine_chunks() for k in {i, j}}
                for s in range(0, len(a), 1 << 16):
                    at = slice(s, s + (1 << 16))
                    yield pa.RecordBatch.from_arrays([names[i].take(pa.array(a[at])), names[j].take(pa.array(b[at])), *_values(bits[at], cosine[at])], names=["source_id", "target_id", "bits", "cosine"])

        return self._run(each, "source_id string, target_id string, bits int, cosine double")

    def numbers(self) -> DataFrame:
        """``edges`` with numbers of documents, which have the order of their ids, from 0 on: (a, b, bits, cosine)."""
        side = self.side

        def each(found: Iterator[Found]) -> Iterator[pa.RecordBatch]:
            for i, j, a, b, bits, cosine in found:
                for s in range(0, len(a), 1 << 16):
                    at = slice(s, s + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array((i * side + a[at]).astype(np.int32)), pa.array((j * side + b[at]).astype(np.int32)), *_values(bits[at], cosine[at])], names=["a", "b", "bits", "cosine"])

        return self._run(each, "a int, b int, bits int, cosine double")

    def degrees(self) -> DataFrame:
        """(source_id, degree): pairs of each document at either end; no pair leaves its task."""
        side = self.side

        def each(found: Iterator[Found]) -> Iterator[pa.RecordBatch]:
            for i, j, a, b, _, _ in found:
                for block, at in ((i, a), (j, b)):
                    many = np.bincount(at, minlength=side)
                    own = many.nonzero()[0]
                    yield pa.RecordBatch.from_arrays([pa.array((block * side + own).astype(np.int32)), pa.array(many[own])], names=["n", "degree"])

        many = self._run(each, "n int, degree bigint").groupBy("n").agg(F.sum("degree").alias("degree"))
        return self.ids.join(many, "n").select("source_id", "degree")


def _values(bits: np.ndarray, cosine: np.ndarray) -> tuple[pa.Array, pa.Array]:
    return pa.array(bits.astype(np.int32)), pa.array(cosine, mask=np.isnan(cosine))


def _arrays(folder: str, block: int) -> tuple[np.ndarray, ...]:
    a, b, bit, cosine = (c.to_numpy() for c in _rows(folder, block, _LINKS).columns)
    return a.astype(np.int64), b.astype(np.int64), bit, cosine


def in_blocks(ids: DataFrame, rules: DataFrame, links: DataFrame, directed: int) -> Blocks:
    """Documents ``ids`` (source_id) with ``rules`` (bit, bucket, source_id, give, take) and ``links`` (source_id, target_id, bit, cosine), in blocks.

    Two documents of a bucket are a pair of its rule if what the first gives and the second
    takes have a bit in common. Rules whose bit is in ``directed`` say something of the first
    and the second, others of both, with the smaller id first. A link stands once.
    """
    spark, side = ids.sparkSession, SIDE
    ids = cut(numbered(ids.select("source_id"), "source_id").select("source_id", (F.col("n") - 1).cast("int").alias("n")), "ids")
    own = F.floor(F.col("n") / side).cast("int").alias("own")
    rules = cut(rules.withColumn("bucket", F.concat_ws(":", "bit", "bucket")).join(ids, "source_id").select("bit", "bucket", "n", "give", "take"), "rules")
    keys = cut(numbered(rules.select("bucket").distinct(), "bucket").select("bucket", F.col("n").alias("key")), "keys")
    held = lookup(rules, keys, "bucket", "inner").select("bit", "key", "n", "give", "take", own)
    held = cut_by(held.repartition("own"), "own", "sides")
    drop_cut(rules, keys)
    a, b = ids.select("source_id", F.col("n").alias("a")), ids.select(F.col("source_id").alias("target_id"), F.col("n").alias("b"))
    pairs = links.join(a, "source_id").join(b, "target_id").select("a", "b", "bit", "cosine", F.floor(F.least("a", "b") / side).cast("int").alias("own"))
    pairs = cut_by(pairs.repartition("own"), "own", "links")
    names = cut_by(ids.select("source_id", "n", own).repartition("own"), "own", "names")
    return Blocks(spark, ids, held, pairs, names, max(1, -(-ids.count() // side)), side, directed)
