"""Nearest documents by the cosine of their weighted words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kbspark.functions.titles import words
from kbspark.plans.lineage import cut, cut_by, drop_cut
from kbspark.plans.skew import lookup, small

#: Classes in a block, fewest blocks of as many classes as LEAST_BLOCK, and rows of the product a task holds at once.
BLOCK, BLOCKS, LEAST_BLOCK, CHUNK = 16_384, 6, 1_024, 256
#: Tasks that pairs of blocks make at least.
TASKS = 64
#: Kinds of rows that blocks keep apart, words and rows they are learnt from.
KINDS, HEADS, SAMPLE = 4, 1_024, 4_096
#: Words that are broadcast at most.
WORDS = 100_000
#: Products of postings, and cosines of pairs, that are worked out at once.
POSTINGS, PAIRS = 500_000, 20_000
#: A word that more than this share of both blocks has, or of one as much more as of the other less, is a dense column.
HOT = 0.05
#: More than what products in single precision are off by, and half a unit of the last place of a cosine.
MARGIN = 1e-5


def whole_profile() -> Column:
    """Name, summary, theme, keywords and business objects of a document."""
    return F.concat_ws("\n", "file_name", "summary", "core_theme", F.array_join("keywords", "\n"), F.array_join("business_objects", "\n"))


def short_profile() -> Column:
    """Name, theme and keywords of a document."""
    return F.concat_ws("\n", "file_name", "core_theme", F.array_join("keywords", "\n"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source_id, word, c) of documents with their words; a document is one row, so that nothing is shuffled."""
    for batch in batches:
        lists = batch.column("words")
        flat = lists.flatten().dictionary_encode()
        if not len(flat):
            continue
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        key, c = np.unique(row * len(flat.dictionary) + flat.indices.to_numpy(zero_copy_only=False), return_counts=True)
        row, word = np.divmod(key, len(flat.dictionary))
        yield pa.RecordBatch.from_arrays([batch.column("source_id").take(pa.array(row)), flat.dictionary.take(pa.array(word)), pa.array(c.astype(np.int32))], names=["source_id", "word", "c"])


def _starts(lists: pa.ListArray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


class Weighing:
    """Weights of words by their numbers and counts: (1 + ln count) (ln((1 + N) / (1 + n)) + 1), scaled to length 1 per row.

    Words are numbered by how many documents have them, so that a step for each such number
    is all that is sent: fewer than the root of twice the postings.
    """

    def __init__(self, n_all: int, steps: list[tuple[int, int]]):
        documents, many = (np.array(x, dtype=np.int64) for x in zip(*sorted(steps))) if steps else (np.empty(0, np.int64),) * 2
        self.n_words = int(many.sum())
        self.first, self.idf = np.cumsum(many) - many, np.log((1 + n_all) / (1 + documents.astype(np.float64))) + 1

    def of(self, no: np.ndarray, c: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        w = (1 + np.log(c)) * self.idf[np.searchsorted(self.first, no, side="right") - 1]
        return w / np.sqrt(np.bincount(row, w * w, rows))[row]


def numbered_words(counted: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """((word, no): all words, numbered from 0 on in the order of the documents that have them; (documents, words) of every such number)."""
    known = cut(counted.groupBy("word").agg(F.count(F.lit(1)).alias("documents")).orderBy("documents").withColumn("id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("id", 33)
    sizes = sorted((r["p"], r["n"]) for r in known.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    steps = [(r["documents"], r["n"]) for r in known.groupBy("documents").agg(F.count(F.lit(1)).alias("n")).collect()]
    first = F.array(*[F.lit(x).cast("bigint") for x in accumulate([0, *[n for _, n in sizes]])])
    place = F.array_position(F.array(*[F.lit(p).cast("bigint") for p, _ in sizes]), part).cast("int")
    return known.select("word", (F.get(first, place - 1) + F.col("id").bitwiseAND((1 << 33) - 1)).cast("int").alias("no")), steps


def word_vectors(docs: DataFrame, text: Column) -> tuple[DataFrame, Weighing]:
    """((source_id, name, words, counts): numbers of the words of ``text``, ascending, and how often each occurs; their weights).

    ``name`` is a hash of words and weights, these to nine places. Documents without words have no row.
    """
    own = cut(docs.select("source_id", words(text).alias("words")), "words")
    counted = own.mapInArrow(_counted, "source_id string, word string, c int")
    numbered, steps = numbered_words(counted)
    weighing = Weighing(own.count(), steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, start = batch.column("v"), _starts(batch.column("v"))
            no, c = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            row = np.repeat(np.arange(batch.num_rows), np.diff(start))
            order = np.lexsort((no, row))
            no, c = no[order], c[order]
            places = np.rint(weighing.of(no, c, row, batch.num_rows) * 1e9).astype(np.int64)
            names = [xxhash.xxh3_128_hexdigest(no[a:e].tobytes() + places[a:e].tobytes()) for a, e in zip(start[:-1], start[1:])]
            lists = [pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(x)) for x in (no, c)]
            yield pa.RecordBatch.from_arrays([batch.column("source_id"), pa.array(names, pa.string()), *lists], names=["source_id", "name", "words", "counts"])

    rows = counted.join(small(numbered, WORDS), "word").groupBy("source_id").agg(F.collect_list(F.struct("no", "c")).alias("v"))
    return rows.mapInArrow(run, "source_id string, name string, words array<int>, counts array<int>"), weighing


def classes_of(named: DataFrame) -> DataFrame:
    """(name, first, words, counts): documents with the same vector, by their smallest member."""
    classes = named.groupBy("name").agg(F.min_by(F.struct("source_id", "words", "counts"), "source_id").alias("f"))
    return classes.select("name", F.col("f.source_id").alias("first"), F.col("f.words").alias("words"), F.col("f.counts").alias("counts"))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each first on, as many as its size."""
    before = np.cumsum(size) - size
    return np.repeat(first - before, size) + np.arange(int(size.sum()))


class _Rows:
    """Sparse rows, each with its words ascending."""

    def __init__(self, start: np.ndarray, word: np.ndarray, weight: np.ndarray):
        self.start, self.word, self.weight = start, word, weight

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> _Rows:
        size = np.diff(self.start)[rows]
        at = _ranges(self.start[:-1][rows], size)
        return _Rows(np.concatenate([[0], np.cumsum(size)]), self.word[at], self.weight[at])

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.start))


def _products(left: _Rows, right: _Rows, n_words: int) -> Iterator[tuple[int, _Rows, np.ndarray]]:
    """(first row, rows, their products with all of ``right`` in single precision) of CHUNK rows of ``left`` at a time: hot words as dense columns, others by postings."""
    order = np.argsort(right.word, kind="stable")
    col, weight = right.row()[order], right.weight[order].astype(np.float32)
    size = np.bincount(right.word, minlength=n_words)
    start = np.concatenate([[0], np.cumsum(size)])
    # a word of few rows on one side makes few products, however many it has on the other
    hot = size * np.bincount(left.word, minlength=n_words) > HOT * HOT * len(left) * len(right)
    no = np.cumsum(hot) - 1
    dense = np.zeros((int(hot.sum()), len(right)), dtype=np.float32)
    own = np.repeat(hot, size)
    dense[np.repeat(no, size)[own], col[own]] = weight[own]
    for b in range(0, len(left), CHUNK):
        rows = left.take(np.arange(b, min(b + CHUNK, len(left))))
        row, thick = rows.row(), hot[rows.word]
        mine = np.zeros((len(rows), len(dense)), dtype=np.float32)
        mine[row[thick], no[rows.word[thick]]] = rows.weight[thick]
        score = mine @ dense
        flat = score.reshape(-1)
        row, word, w = row[~thick], rows.word[~thick], rows.weight[~thick].astype(np.float32)
        ends = np.cumsum(size[word])
        a = 0
        while a < len(word):
            # as many as stay under POSTINGS, one at least
            e = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + POSTINGS, side="right")))
            k = size[word[a:e]]
            at = _ranges(start[word[a:e]], k)
            np.add.at(flat, np.repeat(row[a:e] * len(right), k) + col[at], np.repeat(w[a:e], k) * weight[at])
            a = e
        yield b, rows, score


def _exact(rows: _Rows, right: _Rows, i: np.ndarray, j: np.ndarray, n_words: int) -> np.ndarray:
    """Cosines, to six places, of rows ``i`` of a chunk with rows ``j`` of ``right``."""
    known = np.unique(rows.word)
    place = np.full(n_words, len(known))
    place[known] = np.arange(len(known))
    wide = np.zeros((len(rows), len(known) + 1))
    wide[rows.row(), place[rows.word]] = rows.weight
    out = np.empty(len(i))
    for b in range(0, len(i), PAIRS):
        other = right.take(j[b : b + PAIRS])
        # every row has a word
        out[b : b + PAIRS] = np.add.reduceat(wide[i[b : b + PAIRS][other.row()], place[other.word]] * other.weight, other.start[:-1])
    return np.round(out, 6)


def _cosines(left: _Rows, right: _Rows, i: np.ndarray, j: np.ndarray, n_words: int) -> np.ndarray:
    """Cosines, to six places, of rows ``i`` of ``left`` with rows ``j`` of ``right``."""
    order = np.argsort(i, kind="stable")
    i, j, out = i[order], j[order], np.empty(len(i))
    a = 0
    while a < len(i):
        first = int(i[a])
        e = int(np.searchsorted(i, first + CHUNK))
        rows = left.take(np.arange(first, min(first + CHUNK, len(left))))
        out[order[a:e]] = _exact(rows, right, i[a:e] - first, j[a:e], n_words)
        a = e
    return out


def _first_of_each(group: np.ndarray, cosine: np.ndarray, target: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best of each group: by cosine, of equal ones the smaller target."""
    order = np.lexsort((target, -cosine, group))
    return order[np.arange(len(order)) - np.searchsorted(group[order], group[order]) < most]


class _Best:
    """The pairs that may be among the ``most`` best of their own rows, by products in single precision until it takes cosines to tell.

    ``floor`` rises to what is still of use for each row. What is held stays bounded, also
    where all products are equal.
    """

    def __init__(self, floor: np.ndarray, most: int, cosines: Callable[[np.ndarray, np.ndarray], np.ndarray], threshold: float):
        self.floor, self.most, self.cosines, self.threshold = floor, most, cosines, threshold
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        self.n, self.bound = 0, 4 * most * len(floor) + CHUNK

    def add(self, own: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
        good = score >= self.floor[own]
        self.held.append((own[good], other[good], score[good]))
        self.n += int(good.sum())
        if self.n > self.bound:
            self._near()
        if self.n > self.bound:
            self.best()

    def _rise(self, own: np.ndarray, score: np.ndarray, margin: float) -> None:
        """Floors from rows in order, each with its scores from the best on."""
        last = (np.arange(len(own)) - np.searchsorted(own, own) == self.most - 1).nonzero()[0]
        self.floor[own[last]] = np.maximum(self.floor[own[last]], score[last] - margin)

    def _near(self) -> None:
        own, other, score = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((-score, own))
        # both what makes the floor and what is held against it are off by less than a margin
        self._rise(own[order], score[order], 2 * MARGIN)
        good = score >= self.floor[own]
        self.held, self.n = [(own[good], other[good], score[good])], int(good.sum())

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(own, other, cosine) of the best of each row, which alone are held from now on."""
        self._near()
        own, other, _ = self.held[0]
        cosine = self.cosines(own, other)
        good = (cosine >= self.threshold).nonzero()[0]
        good = good[_first_of_each(own[good], cosine[good], other[good], self.most)]
        own, other, cosine = own[good], other[good], cosine[good]
        self._rise(own, cosine, MARGIN)
        self.held, self.n = [(own, other, cosine)], len(own)
        return own, other, cosine


def best_of_blocks(left: _Rows, right: _Rows, same: bool, n_words: int, threshold: float, most: int) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
    """(whether turned, source, target, cosine) of the ``most`` nearest rows of ``right`` of each of ``left`` and, turned, the other way round.

    A pair is looked at exactly if its product in single precision is near enough to the
    most-th best of either end among the rows at hand; ``same`` says that both are one block.
    """
    least = threshold - MARGIN
    sides = [_Best(np.full(len(rows), least, dtype=np.float32), most, cosines, threshold) for rows, cosines in ((left, lambda i, j: _cosines(left, right, i, j, n_words)), (right, lambda j, i: _cosines(left, right, i, j, n_words)))]
    for b, _, score in _products(left, right, n_words):
        if same:
            score[np.arange(len(score)), b + np.arange(len(score))] = -1.0
        at = (score.reshape(-1) >= least).nonzero()[0]
        found = score.reshape(-1)[at]
        i, j = np.divmod(at, len(right))
        sides[0].add(b + i, j, found)
        if not same:
            sides[1].add(j, b + i, found)
    for turned in (False, True)[: 2 - same]:
        yield turned, *sides[turned].best()


#: Columns of a class in a block.
_CLASSES = pa.schema([("first", pa.string()), ("words", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])


def _rows_of(rows: pa.RecordBatch | pa.Table, weighing: Weighing) -> _Rows:
    lists, counts = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (rows.column("words"), rows.column("counts")))
    start = _starts(lists)
    no, c = (x.flatten().to_numpy(zero_copy_only=False) for x in (lists, counts))
    return _Rows(start, no, weighing.of(no, c, np.repeat(np.arange(len(lists)), np.diff(start)), len(lists)))


class Block:
    """The classes of one block, in order, in arrays: their smallest members, and the numbers and weights of their words."""

    def __init__(self, folder: str, block: int, weighing: Weighing):
        files, root = fs.FileSystem.from_uri(f"{folder}/own={block}")
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        tables = [pq.ParquetFile(files.open_input_file(x.path)).read() for x in found if x.base_name.endswith(".parquet")]
        t = pa.concat_tables([_CLASSES.empty_table(), *(x.select(_CLASSES.names).cast(_CLASSES) for x in tables)]).sort_by("first")
        self.names, self.rows = t.column("first").combine_chunks(), _rows_of(t, weighing)


def best_in_blocks(left: Block, right: Block, same: bool, threshold: float, most: int) -> Iterator[pa.RecordBatch]:
    """(source_id, target_id, cosine) of a pair of blocks: the ``most`` nearest ones of each in the other block."""
    if not len(left.rows) or not len(right.rows):
        return
    # numbers of the words of the left block, without gaps; others meet nothing
    known = np.unique(left.rows.word)
    place = np.full(max(int(known[-1]), int(right.rows.word.max())) + 1, -1, dtype=np.int32)
    place[known] = np.arange(len(known), dtype=np.int32)

    def within(rows: _Rows) -> _Rows:
        word = place[rows.word]
        own = word >= 0
        return _Rows(np.concatenate([[0], np.cumsum(own)])[rows.start], word[own], rows.weight[own])

    sides = (left, right)
    for turned, source, target, cosine in best_of_blocks(within(left.rows), within(right.rows), same, len(known), threshold, most):
        yield pa.RecordBatch.from_arrays([sides[turned].names.take(pa.array(source)), sides[not turned].names.take(pa.array(target)), pa.array(cosine)], names=["source_id", "target_id", "cosine"])


class Kinds:
    """Directions of common words, learnt from a sample, that tell which blocks rows go to, so that rows of one language meet in one block; what a block finds doesn't depend on them."""

    def __init__(self, rows: _Rows, n_words: int):
        # words are numbered by how many documents have them
        self.first, self.width = max(0, n_words - HEADS), HEADS
        x = self._wide(rows)
        heads = x[:1].copy()
        near = x @ heads[0]
        while len(heads) < min(KINDS, len(x)):
            heads = np.concatenate([heads, x[[int(near.argmin())]]])
            near = np.maximum(near, x @ heads[-1])
        for _ in range(8):
            own = self._nearest(x, heads)
            heads = np.stack([x[own == k].mean(axis=0) if (own == k).any() else heads[k] for k in range(len(heads))])
            heads /= np.maximum(np.sqrt((heads * heads).sum(axis=1)), 1e-9)[:, None]
        self.heads, self.shares = heads, np.bincount(self._nearest(x, heads), minlength=len(heads)) / len(x)

    def _wide(self, rows: _Rows) -> np.ndarray:
        own = rows.word >= self.first
        x = np.zeros((len(rows), self.width), dtype=np.float32)
        x[rows.row()[own], rows.word[own] - self.first] = rows.weight[own]
        return x

    @staticmethod
    def _nearest(x: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return (x @ heads.T).argmax(axis=1)

    def of(self, rows: _Rows) -> np.ndarray:
        return self._nearest(self._wide(rows), self.heads)


def write_blocks(classes: DataFrame, weighing: Weighing) -> tuple[str, int]:
    """(folder, number of its blocks): classes in blocks of about as many rows, near kinds together, for tasks that read some of them on their own."""
    n = classes.count()
    blocks = max(1, -(-n // BLOCK), min(BLOCKS, -(-n // LEAST_BLOCK)))
    h = F.xxhash64("first")
    sample = classes.where(F.pmod(h, F.lit(max(1, n // SAMPLE))) == 0).select("first", "words", "counts").toArrow().sort_by("first") if n > BLOCK else None
    kinds = Kinds(_rows_of(sample, weighing), weighing.n_words) if sample is not None and len(sample) else None
    many = np.maximum(1, np.ceil(kinds.shares * blocks - 0.25)).astype(np.int64) if kinds else np.array([blocks])
    first = np.cumsum(many) - many

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = kinds.of(_rows_of(batch, weighing)) if kinds else np.zeros(batch.num_rows, np.int64)
            # the sample's hashes are apart by their last digits
            own = first[kind] + (batch.column("h").to_numpy() >> 20) % many[kind]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *(batch.column(c) for c in _CLASSES.names)], names=["own", *_CLASSES.names])

    table = classes.select(*_CLASSES.names, h.alias("h")).mapInArrow(run, "own int, first string, words array<int>, counts array<int>")
    return cut_by(table.repartition("own"), "own", "blocks"), int(many.sum())


def pairs_of_blocks(blocks: int) -> list[tuple[int, list[int]]]:
    """Every pair of blocks once, those that a task does with the same first one together: at least TASKS tasks, where there are as many pairs."""
    strips = [[(i + d) % blocks for d in range(blocks // 2 + 1) if 2 * d < blocks or i < d] for i in range(blocks)]
    run = max(1, sum(len(x) for x in strips) // TASKS)
    return [(i, x[k : k + run]) for i, x in enumerate(strips) for k in range(0, len(x), run)]


def nearest_classes(classes: DataFrame, weighing: Weighing, threshold: float, most: int) -> DataFrame:
    """(source_id, target_id, cosine, rank) of each class the ``most`` nearest others, by their smallest members.

    Classes fall into blocks, and each pair of blocks is read by one task that finds the
    nearest ones both ways: exact at any threshold; the work grows as the square of the classes.
    """
    folder, blocks = write_blocks(classes, weighing)
    tasks = pairs_of_blocks(blocks)
    threshold = float(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                i, others = tasks[k]
                left = Block(folder, i, weighing)
                for j in others:
                    yield from best_in_blocks(left, left if i == j else Block(folder, j, weighing), i == j, threshold, most)

    spark = classes.sparkSession
    found = spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(run, "source_id string, target_id string, cosine double")
    # ranks beyond most are cut off before the shuffle
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("cosine"), "target_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def cosine_neighbours(docs: DataFrame, threshold: float = 0.5, most: int = 10) -> DataFrame:
    """(source_id, target_id, cosine, rank): the ``most`` nearest documents of each with a cosine of at least ``threshold``.

    Words are those of name, theme and keywords. Documents with the same words are one class
    (by a hash of their weighted words), so that copies are compared once; ranks go over
    classes, and each class stands with its smallest member. Documents without words have no
    neighbours.
    """
    named, weighing = word_vectors(docs, short_profile())
    return nearest_classes(cut(classes_of(named), "classes"), weighing, threshold, most)


def nearest_documents(docs: DataFrame, threshold: float = 0.12, most: int = 10) -> DataFrame:
    """(source_id, class_id, target_id, cosine, rank): of every document the ``most`` nearest ones, copies included, with a cosine of at least ``threshold``.

    Words are those of the whole profile. Documents with the same weighted words are one
    class, named by its smallest member. A class stands for its ``most`` + 1 smallest
    members, as many as the list of a document can hold besides itself, so that nothing is
    expanded beyond ``most`` rows a document.
    """
    named, weighing = word_vectors(docs, whole_profile())
    named = cut(named, "named")
    classes = cut(classes_of(named), "classes")
    members = cut(named.select("source_id", "name").join(classes.select("name", "first"), "name").select("source_id", "first"), "members")
    drop_cut(named)
    own = classes.select(F.col("first").alias("source_id"), F.col("first").alias("target_id"), F.lit(1.0).alias("cosine"))
    near = nearest_classes(classes, weighing, threshold, most).drop("rank").unionByName(own)
    # ranks beyond most + 1 are cut off before the shuffle
    nth = F.row_number().over(Window.partitionBy("first").orderBy("source_id"))
    few = members.withColumn("nth", nth).where(F.col("nth") <= most + 1).select(F.col("first").alias("target_id"), F.col("source_id").alias("member"))
    lists = near.join(few, "target_id").groupBy("source_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("c"), F.col("member").alias("m")))), 1, most + 1).alias("l"))
    each = lookup(members, lists.withColumnRenamed("source_id", "first"), "first", "inner")
    each = each.withColumn("l", F.slice(F.filter("l", lambda x: x["m"] != F.col("source_id")), 1, most))
    each = each.select("source_id", F.col("first").alias("class_id"), F.posexplode("l").alias("k", "x"))
    return each.select("source_id", "class_id", F.col("x.m").alias("target_id"), (-F.col("x.c")).alias("cosine"), (F.col("k") + 1).alias("rank"))
