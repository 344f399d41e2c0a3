"""Near-duplicate texts with small edits by prefix filtering on character n-grams."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbspark.functions.text import canonical_id
from kbspark.llm.corpus import corpus_counts
from kbspark.llm.grouping import connected_groups
from kbspark.llm.units import mix
from kbspark.plans.lineage import cut, cut_by
from kbspark.plans.skew import small

#: Fixed by the problem: similarity, characters in a sequence, shortest compared text.
THRESHOLD, N, SHORTEST = 0.7, 5, 100
#: Sequences two similar texts must share among their rarest ones, beyond what the prefix filter asks.
SHARED = 8
SKETCH_BITS = 24
#: Texts and postings of a group at most, and groups there are at least where each has as many postings as LEAST.
BLOCK, POSTED, GROUPS, LEAST = 1 << 16, 8_000_000, 12, 100_000
#: Postings that a task looks for, and meetings that it counts, at once.
STREAMED, COUNTED = 1 << 19, 2_000_000
#: Groups that a task compares with one other.
BESIDE = 4
#: Copies of one text that are joined in one piece.
COPIES = 1000


def raw(texts: DataFrame) -> DataFrame:
    """(source_id, content, summary) of the rows with an id, as they are."""
    rows = texts.select(canonical_id("source_id").alias("source_id"), F.col("content").cast("string").alias("content"), F.col("summary").cast("string").alias("summary"))
    return rows.where(F.col("source_id").isNotNull())


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point whether it is a letter or a number; from Unicode's own data, once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((unicodedata.category(chr(i))[0] in "LN" for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def compared(content: str | None, summary: str | None) -> np.ndarray | None:
    """Lower-cased letters and digits of content or, where blank, of summary, as code points; None under SHORTEST."""
    text = content if content and content.strip() else summary
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = c[_letters()[c]]
    return c if len(c) >= SHORTEST else None


class Texts:
    """The compared texts of a task's batches; with ``once``, copies within the task only once.

    A text is named by a 128-bit hash that all its copies share, its class, so that copies
    are never gathered: a third of all rows may be copies of one text.
    """

    def __init__(self, once: bool):
        self.seen: set[int] | None = set() if once else None

    def of(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        """(row, class, code points)."""
        for row, (content, summary) in enumerate(zip(batch.column("content"), batch.column("summary"))):
            c = compared(content.as_py(), summary.as_py())
            if c is not None:
                name = xxhash.xxh3_128_intdigest(c.tobytes())
                if self.seen is None:
                    yield row, name, c
                elif name not in self.seen:
                    self.seen.add(name)
                    yield row, name, c


def every_sequence(codes: np.ndarray | str) -> np.ndarray:
    """Hashes of the sequences of N characters, in order, with repeats."""
    if isinstance(codes, str):
        codes = np.frombuffer(codes.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = codes.astype(np.uint64)
    if len(c) < N:
        return np.empty(0, dtype=np.uint64)
    h = c[: len(c) - N + 1].copy()
    for i in range(1, N):
        h = h * np.uint64(0x9E3779B97F4A7C15) + c[i : len(c) - N + 1 + i]
    return mix(h, N)


def sequences(codes: np.ndarray | str) -> np.ndarray:
    """Distinct hashes of the sequences of N characters, ascending."""
    return np.unique(every_sequence(codes))


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


#: Steps of lengths of a hundredth, up to the longest text there can be.
_LENGTHS = 2048


def _step(length: int) -> int:
    return int(100 * math.log(length / SHORTEST)) if length > SHORTEST else 0


def rarity(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, lengths, postings): how often the sequences of each hash bucket occur, over all texts, on a scale of 1/8 octaves; how many texts there are of each step of lengths, and how many postings they have at most.

    2^24 bytes at any size. A bucket's count is at least the number of texts that have one of
    its sequences: code 0 means that at most one text has it, so that it can't be shared.
    """
    sketch = 1 << SKETCH_BITS

    def add(counts: np.ndarray, batch: pa.RecordBatch) -> None:
        for _, _, c in Texts(once=True).of(batch):
            np.add.at(counts, _bucket(every_sequence(c)), 1)
            counts[sketch + _step(len(c))] += 1
            counts[sketch + _LENGTHS + _step(len(c))] += prefix_length(len(c))

    counts = corpus_counts(texts.select("content", "summary"), add, sketch + 2 * _LENGTHS)
    codes = np.minimum(255, np.ceil(8 * np.log2(np.maximum(counts[:sketch], 1)))).astype(np.uint8)
    return codes, counts[sketch : sketch + _LENGTHS], counts[sketch + _LENGTHS :]


def prefix_length(size: int) -> int:
    """Rarest sequences of a set of ``size`` among which a similar set has at least SHARED of its own rarest."""
    return size - int(np.ceil(THRESHOLD * size - 1e-9)) + SHARED


def least_overlap(a, b):
    """Sequences that two sets of these sizes share if they are similar enough."""
    return np.ceil(THRESHOLD / (1 + THRESHOLD) * (a + b) - 1e-9)


#: Fewest and most parts of the hash range in which the suffix filter counts, as powers of two.
LEAST_PARTS, MOST_PARTS = 7, 13


def _profile(h: np.ndarray) -> bytes:
    """How many sequences of a text fall into each part of the hash range, at most 15, two to a byte; about two sequences a part."""
    bits = min(MOST_PARTS, max(LEAST_PARTS, len(h).bit_length() - 1))
    n = np.minimum(15, np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)).astype(np.uint8)
    return (n[::2] | (n[1::2] << 4)).tobytes()


def apart_at_least(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Suffix filter: lower bounds of the sequences that only one of two texts has, from their profiles.

    Equal sequences fall into the same part, so that the parts' differences add up to no
    more than the sequences that differ; cutting at 15 only makes them smaller, also after
    the parts of the finer profile are put together.
    """
    out = np.zeros(len(x), dtype=np.int64)
    sizes = np.array([[len(a), len(b)] for a, b in zip(x, y)]).reshape(-1, 2)
    for size in np.unique(sizes, axis=0):
        at = (sizes == size).all(axis=1).nonzero()[0]
        both = []
        for side in (x, y):
            packed = np.frombuffer(b"".join([side[i] for i in at]), dtype=np.uint8).reshape(len(at), -1)
            n = np.empty((len(at), 2 * packed.shape[1]), dtype=np.int16)
            n[:, ::2], n[:, 1::2] = packed & 15, packed >> 4
            both.append(np.minimum(15, n.reshape(len(at), 2 * size.min(), -1).sum(axis=2)))
        out[at] = np.abs(both[0] - both[1]).sum(axis=1)
    return out


def members_of(texts: DataFrame) -> DataFrame:
    """(source_id, class_id) of every row with a compared text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(row, f"{name:032x}") for row, name, _ in Texts(once=False).of(batch)]
            source = batch.column("source_id").take(pa.array([r for r, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([source, pa.array([i for _, i in found], pa.string())], names=["source_id", "class_id"])

    return texts.mapInArrow(run, "source_id string, class_id string")


def _groups(lengths: np.ndarray, postings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, parts): the groups of each step of lengths; a step with too many texts or postings is spread over several, short ones lie together."""
    most = min(POSTED, max(LEAST, int(postings.sum()) // GROUPS))
    first, parts = np.zeros(_LENGTHS, dtype=np.int64), np.ones(_LENGTHS, dtype=np.int64)
    group, texts, held = 0, 0, 0
    for step in np.nonzero(lengths)[0]:
        n, p = int(lengths[step]), int(postings[step])
        if texts and (texts + n > BLOCK or held + p > most):
            group, texts, held = group + 1, 0, 0
        first[step], parts[step] = group, max(1, -(-n // BLOCK), -(-p // most))
        texts, held = texts + n, held + p
        if parts[step] > 1:
            group, texts, held = group + int(parts[step]), 0, 0
    return first, parts


def grouped(texts: DataFrame, codes: np.ndarray, lengths: np.ndarray, postings: np.ndarray) -> str:
    """Where the table (grp, class_id, size, alone, tokens, profile) was written: the rarest sequences of each text, without those that only one text has.

    ``tokens`` are 32 bits of each sequence's hash, rarest first, after the ``alone`` ones that
    are left out (equal hash bits of different sequences only add candidates). Texts of about
    the same length make a group of a bounded size, one folder each.
    """
    first, parts = _groups(lengths, postings)
    shared = texts.sparkSession.sparkContext.broadcast((codes, first, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, first, parts = shared.value
        own_texts = Texts(once=True)
        for batch in batches:
            for b in range(0, batch.num_rows, 256):
                out: list[list] = [[] for _ in range(6)]
                for _, name, c in own_texts.of(batch.slice(b, 256)):
                    h, step = sequences(c), _step(len(c))
                    code = codes[_bucket(h)]
                    order = (code.astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
                    most = prefix_length(len(h))
                    near = np.argpartition(order, most)[:most] if most < len(h) else np.arange(len(h))
                    near = near[np.argsort(order[near])]
                    # what only one text has is rarest of all
                    alone = int((code[near] == 0).sum())
                    row = (int(first[step]) + name % int(parts[step]), f"{name:032x}", len(h), alone, (h[near[alone:]] >> np.uint64(32)).astype(np.uint32).tobytes(), _profile(h))
                    for column, x in zip(out, row):
                        column.append(x)
                if out[0]:
                    kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["grp", "class_id", "size", "alone", "tokens", "profile"])

    table = texts.select("content", "summary").mapInArrow(run, "grp int, class_id string, size int, alone int, tokens binary, profile binary")
    return cut_by(table.repartition("grp"), "grp", "groups")


class Group:
    """The texts of one group in arrays: of each its class, size and profile; of each posting its text and rank, by the texts and by the tokens."""

    def __init__(self, folder: str, group: int):
        files, root = fs.FileSystem.from_uri(f"{folder}/grp={group}")
        t = pa.concat_tables([pq.ParquetFile(files.open_input_file(x.path)).read() for x in files.get_file_info(fs.FileSelector(root)) if x.base_name.endswith(".parquet")])
        ids = t.column("class_id").to_pylist()
        # a copy in another task's rows
        kept = pa.array(list({i: row for row, i in enumerate(ids)}.values()), pa.int64())
        t = t.take(kept).combine_chunks()
        self.ids, self.profiles = t.column("class_id").to_pylist(), t.column("profile").to_pylist()
        self.size = t.column("size").to_numpy().astype(np.int32)
        tokens = [np.frombuffer(x, dtype=np.uint32) for x in t.column("tokens").to_pylist()]
        n = np.array([len(x) for x in tokens], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(n)])
        self.text = np.repeat(np.arange(len(n), dtype=np.int32), n)
        self.rank = (np.arange(len(self.text)) - np.repeat(self.start[:-1] - t.column("alone").to_numpy(), n)).astype(np.int32)
        packed = np.concatenate([np.empty(0, np.uint32), *tokens]).astype(np.uint64) << np.uint64(32)
        packed |= np.arange(len(packed), dtype=np.uint64)
        packed.sort()
        self.token, self.by = (packed >> np.uint64(32)).astype(np.uint32), (packed & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _places(near: Group, far: Group) -> tuple[np.ndarray, np.ndarray]:
    """(from, number) of the postings of ``far`` with the token of each posting of ``near``."""
    least = np.zeros(len(near.by), dtype=np.int32)
    many = np.zeros(len(near.by), dtype=np.int32)
    size, wide = near.size, far.size
    # a text has as many places as a longer one can need, and none if there is no longer one of its kind
    index = np.where(size < THRESHOLD * wide.min() - 1e-9, 0, size - least_overlap(size, size) + SHARED)
    for b in range(0, len(near.by), STREAMED):
        by, token = near.by[b : b + STREAMED], near.token[b : b + STREAMED]
        good = near.rank[by] < index[near.text[by]]
        by, token = by[good], token[good]
        least[by] = np.searchsorted(far.token, token)
        many[by] = np.searchsorted(far.token, token, side="right") - least[by]
    return least, many


def _met(near: Group, far: Group, order: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text of near, text of far), the shorter one in ``near``, of all pairs that meet at SHARED or more of their rarest sequences, or at as many as they must share if those are fewer.

    Of two groups texts of the same size count for ``order`` < 0 only. The texts of ``near`` are taken a few at a time, so that all meetings of a pair are
    counted where they are found, and none is sent anywhere.
    """
    least, many = _places(near, far)
    per = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
    upto = per[near.start]  # meetings before each text
    t = 0
    while t < len(near.size):
        end = max(t + 1, int(np.searchsorted(upto, upto[t] + COUNTED, side="right")) - 1)
        found, times = np.empty(0, np.int64), np.empty(0, np.int64)
        p = int(near.start[t])
        last = int(near.start[end])
        while p < last:
            # one text alone may have more meetings than are counted at once
            q = min(last, max(p + 1, int(np.searchsorted(per, per[p] + COUNTED, side="right")) - 1))
            n = many[p:q]
            own = np.repeat(np.arange(p, q), n)
            at = np.arange(len(own)) - np.repeat(per[p:q] - per[p], n) + np.repeat(least[p:q], n)
            other = far.by[at]
            i, j = near.text[own], far.text[other]
            a, b = near.size[i], far.size[j]
            # of the first SHARED common sequences each has fewer than SHARED common ones before it
            rest = np.minimum(a - near.rank[own], b - far.rank[other]) - 1
            good = (a <= b) & (a >= THRESHOLD * b - 1e-9) & (rest + SHARED >= least_overlap(a, b))
            good &= (a < b) | (order < 0 if near is not far else i < j)
            key, n = np.unique((i[good].astype(np.int64) - t) * len(far.size) + j[good], return_counts=True)
            if len(found):
                key, back = np.unique(np.concatenate([found, key]), return_inverse=True)
                n = np.bincount(back, np.concatenate([times, n]), len(key)).astype(np.int64)
            found, times, p = key, n, q
        i, j = np.divmod(found, len(far.size))
        i += t
        good = times >= np.minimum(SHARED, least_overlap(near.size[i], far.size[j]))
        if good.any():
            yield i[good], j[good]
        t = end


def _near_enough(near: Group, far: Group, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(a, b) class ids of the pairs that pass the suffix filter, some at a time."""
    for k in range(0, len(i), 10_000):
        own, other = i[k : k + 10_000], j[k : k + 10_000]
        a, b = near.size[own].astype(np.int64), far.size[other].astype(np.int64)
        apart = apart_at_least([near.profiles[x] for x in own], [far.profiles[x] for x in other])
        good = (apart <= a + b - 2 * least_overlap(a, b)).nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array([g.ids[x] for x in y[good]], pa.string()) for g, y in ((near, own), (far, other))], names=["a", "b"])


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """(a, b) class ids of the pairs of the groups in ``folder`` that pass all filters.

    Each pair of groups whose sizes can fit is compared by one task, which reads both groups
    and counts their meetings: these grow faster than the texts, and none is written or shuffled.
    """
    sizes = spark.read.schema("size int, grp int").parquet(folder).groupBy("grp").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    groups = sorted((r["grp"], r["least"], r["most"]) for r in sizes.collect())
    work = []
    for k, (h, least, most) in enumerate(groups):
        beside = [g for g, low, high in groups[: k + 1] if high >= THRESHOLD * least - 1e-9 and most >= THRESHOLD * low - 1e-9]
        many = min(BESIDE, max(1, len(groups) // GROUPS))
        work += [(h, beside[b : b + many]) for b in range(0, len(beside), many)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, beside in zip(*(c.to_pylist() for c in batch.columns)):
                far = Group(folder, h)
                for g in beside:
                    near = far if g == h else Group(folder, g)
                    for x, y, order in ((near, far, -1),) if near is far else ((near, far, -1), (far, near, 1)):
                        if x.size.min() <= y.size.max() and x.size.max() >= THRESHOLD * y.size.min() - 1e-9:
                            for i, j in _met(x, y, order):
                                yield from _near_enough(x, y, i, j)

    tasks = spark.createDataFrame(work, "h int, beside array<int>").repartition(max(1, len(work)))
    return tasks.mapInArrow(run, "a string, b string")


_NEEDED_BITS = 22


def needed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(class_id, text) of the texts that occur in ``pairs``, each once.

    A bitmap of a fixed size tells every task which of its texts may be needed, so that only
    those are shuffled; the join that follows decides.
    """
    cells = 1 << _NEEDED_BITS

    def add(marks: np.ndarray, batch: pa.RecordBatch) -> None:
        for column in batch.columns:
            marks[[int(i, 16) & (cells - 1) for i in column.to_pylist()]] = 1

    marks = texts.sparkSession.sparkContext.broadcast(corpus_counts(pairs.select("a", "b"), add, cells) > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, own = marks.value, Texts(once=True)
        for batch in batches:
            found = [(f"{name:032x}", c.tobytes().decode("utf-32-le", "surrogatepass")) for _, name, c in own.of(batch) if wanted[name & (cells - 1)]]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.string()), pa.array([t for _, t in found], pa.string())], names=["class_id", "text"])

    return texts.select("content", "summary").mapInArrow(run, "class_id string, text string").dropDuplicates(["class_id"])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets are similar by THRESHOLD, exactly."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= THRESHOLD * (len(x) + len(y) - both) - 1e-9


def verified(left_over: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) class ids of the candidates whose texts are similar: each pair exactly once."""
    own = needed(left_over, texts)
    left = own.select(F.col("class_id").alias("a"), F.col("text").alias("text_a"))
    right = own.select(F.col("class_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, np.ndarray] = {}
            ids = [batch.column(0).to_pylist(), batch.column(1).to_pylist()]
            good = []
            for ia, ib, ta, tb in zip(ids[0], ids[1], batch.column(2), batch.column(3)):
                for i, t in ((ia, ta), (ib, tb)):
                    if i not in known:
                        known[i] = sequences(t.as_py())
                good.append(similar(known[ia], known[ib]))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(ids[0]).filter(mask), pa.array(ids[1]).filter(mask)], names=["a", "b"])

    return left_over.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a string, b string")


def near_duplicates(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs: a, b of class ids; members: source_id, class_id) of texts similar by at least 0.7.

    ``texts`` has source_id, content and summary; see ``compared`` for what is compared.
    Rare-first prefix filtering: sequences are ordered by how many texts have them (from
    counts over all texts), texts that may be similar share SHARED of their rarest ones (texts
    of few sequences all that they must share), and pairs that meet there, fit in length and
    position, and occur as often as that are verified once. Nothing is capped: all pairs of different texts at or over the threshold are found.
    Copies are members of one class; an empty table gives no rows.
    """
    rows = raw(texts)
    folder = grouped(rows, *rarity(rows))
    pairs = cut(candidates(rows.sparkSession, folder), "pairs")
    return verified(pairs, rows), cut(members_of(rows).distinct(), "members")


def similar_records(texts: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of all pairs of different records with similar texts, copies included.

    The list itself grows as the square of the copies of a text; ``duplicate_groups`` doesn't.
    Members of a class with more than COPIES fall into pieces that are joined one by one.
    """
    pairs, members = near_duplicates(texts)
    size = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).select("class_id", F.ceil(F.col("n") / COPIES).alias("pieces"), "n")
    same = pairs.select("a", "b").unionByName(size.where("n > 1").select(F.col("class_id").alias("a"), F.col("class_id").alias("b")))
    many = size.where("pieces > 1").select("class_id", "pieces")
    sides = {}
    for side, name in (("a", "x"), ("b", "y")):
        own = members.join(small(many), "class_id", "left").select(F.col("source_id").alias(name), F.col("class_id").alias(side), F.pmod(F.xxhash64("source_id"), F.coalesce("pieces", F.lit(1))).alias(f"piece_{side}"))
        of = small(many.select(F.col("class_id").alias(side), F.col("pieces").alias(f"n_{side}")))
        same = same.join(of, side, "left").withColumn(f"piece_{side}", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(f"n_{side}", F.lit(1)) - 1))).drop(f"n_{side}")
        sides[side] = own
    found = same.join(sides["a"], ["a", "piece_a"]).join(sides["b"], ["b", "piece_b"]).where(F.col("x") != F.col("y"))
    return found.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def duplicate_groups(texts: DataFrame) -> DataFrame:
    """(source_id, class_id, group_id, links): the group of each record with a similar or equal text elsewhere.

    group_id is the smallest class of the group; ``links`` counts the other classes that the
    record's class is similar to, so that copies are not expanded into pairs.
    """
    pairs, members = near_duplicates(texts)
    pairs = cut(pairs, "pairs")
    groups = connected_groups(pairs).withColumnRenamed("id", "class_id")
    links = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("links"))
    copies = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("copies"))
    classes = copies.join(groups, "class_id", "left").join(links, "class_id", "left").where("copies > 1 or group_id is not null")
    return members.join(classes, "class_id").select("source_id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
