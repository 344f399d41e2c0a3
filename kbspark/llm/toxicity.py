"""Abusive, hateful and sexual passages by maximum-scoring segments."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbspark.functions.text import canonical_word
from kbspark.llm.corpus import corpus_counts, labelled_sample
from kbspark.llm.units import grams, units
from kbspark.plans.lineage import cut, drop_cut

ORDERS = (1, 2, 3)
#: Size of the Dirichlet prior in proportion to the corpus, and its least count for any n-gram.
PRIOR, FLOOR = 500.0, 0.25
#: Standard errors by which a log-odds ratio must differ from 0, and what every unit costs.
MARGIN, DRIFT = 1.64, 0.5
LOWEST, HIGHEST = -3.0, 6.0
#: Share of the documents found that may be there by chance.
FALSE_SHARE = 0.002

#: n-grams of each order, ascending by hash, and what is known of each.
Model = list[tuple[np.ndarray, np.ndarray]]


def _places(known: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each n-gram stands in ``known``, and whether it is there."""
    if not len(known):
        return np.zeros(len(g), dtype=np.int64), np.zeros(len(g), dtype=bool)
    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
    return at, known[at] == g


def labelled_grams(rows: DataFrame) -> DataFrame:
    """(n, gram, bad, good): how often each n-gram occurs in the texts of either class; ``rows`` has text and toxic.

    n-grams are named by 64-bit hashes; those of a batch are counted before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(0, batch.num_rows, 1000):
                part = batch.slice(b, 1000)
                h, doc, _ = units(part.column(0).to_pylist())
                bad = part.column(1).to_numpy(zero_copy_only=False)[doc] == 1
                for n in ORDERS:
                    g, which = np.unique(grams(h, doc, n, 64), return_inverse=True)
                    counts = [np.bincount(which, weights=w, minlength=len(g)).astype(np.int64) for w in (bad, ~bad)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), n, dtype=np.int32)), pa.array(g), *map(pa.array, counts)], names=["n", "gram", "bad", "good"])

    return rows.select("text", F.col("toxic").cast("int")).mapInArrow(run, "n int, gram bigint, bad bigint, good bigint").groupBy("n", "gram").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _log_odds(bad, good, prior, nb, ng):
    """Log-odds ratio of an n-gram between the classes under a Dirichlet prior, less MARGIN standard errors; 0 within them.

    The prior falls to the classes by their size, so that what neither has says nothing.
    """
    share = nb / (nb + ng)
    yb, yg = bad + prior * 2 * share, good + prior * 2 * (1 - share)
    odds = np.log(yb / (nb - bad + prior + 1)) - np.log(yg / (ng - good + prior + 1))
    return np.sign(odds) * np.maximum(0, np.abs(odds) - MARGIN * np.sqrt(1 / yb + 1 / yg))


def learn(docs: DataFrame, labels: DataFrame, most_labelled: int = 200_000) -> Model:
    """The n-grams of 1 to 3 units that tell the classes apart, and the score of each.

    Of labelled documents (at most about ``most_labelled``, by hash) n-grams are counted by
    class in one aggregate; those whose log-odds differ from 0 under the least prior are
    kept: some 20 000 for 1 000 labels, 60 000 for 10 000, never more than the n-grams of
    ``most_labelled`` documents that occur several times. These are counted over all
    documents for the informative prior, and scored by it. n-grams are told apart by 64-bit
    hashes, so that none takes the score of another at any size of the corpus.
    """
    sample = labelled_sample(labels, "doc_id", "toxic", most_labelled)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    counted = cut(labelled_grams(rows.join(F.broadcast(sample), "doc_id")), "grams")
    totals = {r["n"]: (float(r["nb"]), float(r["ng"])) for r in counted.groupBy("n").agg(F.sum("bad").alias("nb"), F.sum("good").alias("ng")).collect()}

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, bad, good = (b.column(c).to_numpy() for c in (0, 2, 3))
            sizes = np.array([totals[k] for k in n.tolist()]).reshape(-1, 2)
            yield b.filter(pa.array(_log_odds(bad, good, FLOOR, sizes[:, 0], sizes[:, 1]) != 0))

    found = counted.mapInArrow(tell, "n int, gram bigint, bad bigint, good bigint").toPandas() if totals and all(min(x) > 0 for x in totals.values()) else None
    drop_cut(counted)
    if found is None:
        return [(np.empty(0, np.int64), np.empty(0, np.float32)) for _ in ORDERS]
    own = [found[found["n"] == n].sort_values("gram") for n in ORDERS]
    known = docs.sparkSession.sparkContext.broadcast([x["gram"].to_numpy() for x in own])
    first = np.cumsum([0, *map(len, own)])

    def add(counts: np.ndarray, batch: pa.RecordBatch) -> None:
        for b in range(0, batch.num_rows, 1000):
            h, doc, _ = units(batch.slice(b, 1000).column(0).to_pylist())
            counts[-1] += len(h)
            for k, n in enumerate(ORDERS):
                at, there = _places(known.value[k], grams(h, doc, n, 64))
                counts[:-1] += np.bincount(at[there] + first[k], minlength=len(counts) - 1)

    every = corpus_counts(rows.select("text"), add, int(first[-1]) + 1)
    out: Model = []
    for k, (n, x) in enumerate(zip(ORDERS, own)):
        prior = every[first[k] : first[k + 1]] * (PRIOR / max(1, int(every[-1]))) + FLOOR
        out.append((x["gram"].to_numpy(), _log_odds(x["bad"].to_numpy(), x["good"].to_numpy(), prior, *totals[n]).astype(np.float32)))
    return out


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments of one sequence, (score, first, last), in linear time.

    Only runs of positive scores are looked at; what lies between two runs enters by the
    cumulative sums at their ends.
    """
    up = scores > 0
    if not up.any():
        return []
    edge = np.diff(np.concatenate([[False], up, [False]]).astype(np.int8))
    first, last = (edge == 1).nonzero()[0], (edge == -1).nonzero()[0] - 1
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    open_: list[list] = []  # [sum before, sum after, first, last, index of the nearest one that began lower]
    for f, t in zip(first.tolist(), last.tolist()):
        k = [float(total[f]), float(total[t + 1]), f, t, -1]
        j = len(open_) - 1
        while True:
            while j >= 0 and open_[j][0] >= k[0]:
                j = open_[j][4]
            if j < 0 or open_[j][1] >= k[1]:
                k[4] = j
                open_.append(k)
                break
            k = [open_[j][0], k[1], open_[j][2], k[3], -1]
            del open_[j:]
            j = len(open_) - 1
    return [(r - l, f, t) for l, r, f, t, _ in open_]


def passages(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, source, n_units, best, segments): the best segment's score of each document (0: none) and all its maximal segments."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.select(F.col(id_column).alias("id")).dtypes)["id"]
    segment = pa.list_(pa.struct([("score", pa.float32()), ("start_pos", pa.int64()), ("end_pos", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(0, batch.num_rows, 1000):
                part = batch.slice(b, 1000)
                texts = [t or "" for t in part.column(1).to_pylist()]
                h, doc, pos = units(texts)
                s = np.zeros(len(h), dtype=np.float32)
                for n, (known, score) in zip(ORDERS, shared.value):
                    at, there = _places(known, grams(h, doc, n, 64))
                    s[there] += score[at[there]]
                s = np.clip(s, LOWEST, HIGHEST) - np.float32(DRIFT)
                n_units = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
                begin = np.cumsum(n_units) - n_units
                some = np.bincount(doc[s > 0], minlength=len(texts)) if len(doc) else n_units
                best, found = [0.0] * len(texts), [[] for _ in texts]
                for i in some.nonzero()[0].tolist():
                    a, e = int(begin[i]), int(begin[i] + n_units[i])
                    own = segments(s[a:e])
                    best[i] = max(x[0] for x in own)
                    end = [*pos[a + 1 : e].tolist(), len(texts[i])]
                    found[i] = [{"score": x, "start_pos": int(pos[a + f]), "end_pos": int(end[t])} for x, f, t in own]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n_units, pa.int64()), pa.array(best, pa.float64()), pa.array(found, segment)], names=["id", "source", "n_units", "best", "segments"])

    schema = f"id {kind}, source string, n_units bigint, best double, segments array<struct<score float, start_pos bigint, end_pos bigint>>"
    source = F.when(canonical_word("source") != "", canonical_word("source"))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), source.alias("source"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def extreme_values(found: DataFrame) -> tuple[float, float]:
    """(slope, scale) of the distribution of the best score of a harmless document.

    The best of n units exceeds s as often as scale * n * exp(-slope * s) says. Slope from
    the middle of the distribution over all documents, which the few abusive ones hardly
    move; scale by maximum likelihood, in which high scores weigh nothing. One number each.
    """
    some = found.where(F.col("n_units") > 0)
    low, high = 0.5, 0.8
    q = some.agg(F.percentile_approx("best", [low, high], 10_000).alias("q")).first()["q"] or [0.0, 0.0]
    width = -math.log(-math.log(high)) + math.log(-math.log(low))
    slope = width / max(q[1] - q[0], width / 3.0)
    row = some.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n_units") * F.exp(-slope * F.col("best"))).alias("s")).first()
    return slope, (row["n"] / row["s"] if row["s"] else 1.0)


def most_by_chance(found: DataFrame, chance: Column) -> float:
    """The expected number of chance passages in a harmless document up to which a document counts as found.

    The largest (in steps of a tenth of a power of ten) at which no more than FALSE_SHARE of
    the documents found are expected there by chance: the documents' number times the limit.
    What reaches the driver is a histogram of a fixed size.
    """
    step = F.floor(F.least(F.lit(300.0), F.greatest(F.lit(0.0), -F.log10(chance))) * 10).cast("int")
    rows = found.groupBy(F.when((F.col("n_units") > 0) & (F.col("best") > 0), step).otherwise(0).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    n = np.zeros(3001)
    for r in rows:
        n[r["step"]] = r["n"]
    there = np.cumsum(n[::-1])[::-1]
    for k in range(1, 3001):
        if there[k] == 0:
            break
        if n.sum() * 10.0 ** (-k / 10) <= FALSE_SHARE * there[k]:
            return 10.0 ** (-k / 10)
    return 0.0


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, score, n_passages, passages) of every row of ``docs``.

    ``score`` adds up -log10 of the expected number of passages as good by chance, over the
    passages with fewer than one; ``passages`` lists those that are significant: so good that
    of all documents with one at most FALSE_SHARE have it by chance. Null, empty and blank
    texts score 0. Repeated ids are scored row by row; where no document is labelled abusive,
    or none harmless, nothing is known and all score 0. Other columns are ignored.
    """
    found = cut(passages(docs, learn(docs, labels)), "passages")
    slope, scale = extreme_values(found)
    chance = lambda s: F.lit(scale) * F.col("n_units") * F.exp(F.lit(-slope) * s)
    limit = most_by_chance(found, chance(F.col("best")))
    score = F.aggregate(F.transform("segments", lambda x: F.greatest(F.lit(0.0), -F.log10(chance(x["score"])))), F.lit(0.0), lambda a, x: a + x)
    hits = F.filter("segments", lambda x: chance(x["score"]) <= limit)
    return found.select("doc_id", "source", F.round(score, 4).alias("score"), F.size(hits).alias("n_passages"), F.transform(hits, lambda x: F.struct(x["start_pos"].alias("start_pos"), x["end_pos"].alias("end_pos"))).alias("passages"))


def toxic_documents(scored: DataFrame) -> DataFrame:
    """Distinct ids of the documents with a significant passage."""
    return scored.where((F.col("n_passages") > 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def source_rates(scored: DataFrame) -> DataFrame:
    """(source, documents, toxic, rate, mean_score); source trimmed and in lower case, null where missing."""
    return scored.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("n_passages") > 0).alias("toxic"),
        F.round(F.avg((F.col("n_passages") > 0).cast("int")), 6).alias("rate"),
        F.round(F.avg("score"), 4).alias("mean_score"),
    )
