"""Counts over all rows of a corpus in arrays of a fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 16
_ROW = "place int, width int, counts binary"


def _rows(parts: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Slices in the narrowest type that holds them, compressed."""
    place, width, raw = [], [], []
    for p, a in parts:
        kind = np.min_scalar_type(int(a.max()))
        place.append(p)
        width.append(kind.itemsize)
        raw.append(zlib.compress(a.astype(kind).tobytes(), 1))
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(width, pa.int32()), pa.array(raw, pa.binary())], names=["place", "width", "counts"])


def _read(width: int, raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), dtype=f"u{width}").astype(np.int64)


def corpus_counts(df: DataFrame, add: Callable[[np.ndarray, pa.RecordBatch], None], cells: int) -> np.ndarray:
    """The sum over all rows of ``df`` of what ``add(counts, batch)`` adds to ``cells`` counters.

    Every task adds up its own rows, its array is shuffled in slices, and each slice is added
    up by one task, one array at a time. What reaches the driver is ``cells`` numbers,
    whatever the size of the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, dtype=np.int64)
        for b in batches:
            add(counts, b)
        for place in range(0, cells, SLICE):
            part = counts[place : place + SLICE]
            if part.any():
                yield _rows([(place, part)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for place, width, raw in zip(*(c.to_pylist() for c in b.columns)):
                part = _read(width, raw)
                sums[place] = sums[place] + part if place in sums else part
        for place, part in sums.items():
            yield _rows([(place, part)])

    merged = df.mapInArrow(count, _ROW).repartition("place").mapInArrow(merge, _ROW)
    total = np.zeros(cells, dtype=np.int64)
    for place, width, raw in merged.collect():
        part = _read(width, bytes(raw))
        total[place : place + len(part)] = part
    return total


def labelled_sample(labels: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """(key, label) of at most about ``most`` labelled keys, the same ones each time.

    Of labels given twice the larger counts; null labels are none. Over ``most`` keys a hash
    of the key decides, so that the sample is small enough to broadcast at any size.
    """
    one = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias(label))
    n = one.count()
    return one if n <= most else one.where(F.pmod(F.xxhash64(F.col(key)), F.lit(n)) < most)
