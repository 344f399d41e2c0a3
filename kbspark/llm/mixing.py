"""Mixing sources to target weights with soft domain membership."""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbspark.functions.text import canonical_word
from kbspark.llm.corpus import corpus_counts
from kbspark.llm.tokens import FOLDER, NAME, lengths, share_ranks, vocabulary
from kbspark.llm.units import grams, units
from kbspark.plans.lineage import cut, drop_cut

BITS = 16
ORDERS = (1, 2)
SMOOTHING = 0.5
#: How far one n-gram may move the posterior; n-grams of a text are far from independent, so the one that predicts best is taken.
TEMPERATURES = (0.0, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0)
#: Labelled documents on which it is chosen, at most about.
CALIBRATED_ON = 200_000
#: Share of the documents that stand under a source whose kind they are not.
LABEL_NOISE = 0.001
#: Gradient steps after which the rates are written instead of worked out anew.
CARRIED_AFTER = 8


def targets_of(mix_targets: DataFrame) -> list[tuple[str, float, int]]:
    """(source, share, cap) in order of source; one row per source, so a short list at any size.

    Sources compare trimmed and in lower case; of a source given twice the shares add up and
    the smaller cap holds. Shares are scaled to sum 1; rows without source or with a null or
    non-positive share or cap are left out.
    """
    rows = (
        mix_targets.select(canonical_word("source").alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("int").alias("cap"))
        .where((F.col("source") != "") & (F.col("share") > 0) & (F.col("cap") > 0))
        .groupBy("source")
        .agg(F.sum("share").alias("share"), F.min("cap").alias("cap"))
        .orderBy("source")
        .collect()
    )
    whole = sum(r["share"] for r in rows) or 1.0
    return [(r["source"], r["share"] / whole, r["cap"]) for r in rows]


def _gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cell, text) of every n-gram of the texts."""
    h, doc, _ = units(texts)
    cells = [grams(h, doc, n, BITS) + (row << BITS) for row, n in enumerate(ORDERS)]
    return np.concatenate(cells), np.concatenate([doc] * len(ORDERS))


def _scores(texts: list[str], weights: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    """Log-likelihood of each text under each source; where it weighs nothing, it is not worked out."""
    out = np.zeros((len(texts), weights.shape[1]))
    if temperature:
        h, doc, _ = units(texts)
        if len(h):
            first = np.concatenate([[0], (doc[1:] != doc[:-1]).nonzero()[0] + 1])
            for row, n in enumerate(ORDERS):
                out[doc[first]] += np.add.reduceat(weights[grams(h, doc, n, BITS) + (row << BITS)], first, axis=0)
    return out


def _posterior(score: np.ndarray, log_prior: np.ndarray, temperature: float) -> np.ndarray:
    p = score * temperature + log_prior
    p = np.exp(p - p.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _likelihoods(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood of each n-gram cell under each source, and the log-prior in the last row, from counts by source."""
    out = np.empty((counts.shape[1], counts.shape[0]), dtype=np.float32)
    out[-1] = np.log((counts[:, -1] + 1) / (counts[:, -1] + 1).sum())
    for row in range(len(ORDERS)):
        c = counts[:, row << BITS : (row + 1) << BITS] + SMOOTHING
        out[row << BITS : (row + 1) << BITS] = np.log(c / c.sum(axis=1, keepdims=True)).T
    return out


def learn_domains(docs: DataFrame, sources: list[str]) -> tuple[np.ndarray, float]:
    """(log-likelihood of each n-gram cell under each source with the log-prior last, temperature).

    Multinomial naive Bayes over all documents with a source of the list (the labelled
    table), counted in two halves by a hash of the id. The temperature is the one at which
    each half predicts the sources of the other with the least loss, on at most about
    CALIBRATED_ON documents: where texts say nothing of their source it is 0, and the
    posterior of a text is the prior. What is counted is of a fixed size.
    """
    place = {s: i for i, s in enumerate(sources)}
    k, cells = len(sources), (len(ORDERS) << BITS) + 1
    rows = docs.select("text", canonical_word("source").alias("source"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("draw")).where(F.col("text").isNotNull() & F.col("source").isin(*sources))

    def add(counts: np.ndarray, batch: pa.RecordBatch) -> None:
        for b in range(0, batch.num_rows, 1000):
            part = batch.slice(b, 1000)
            who = np.array([place[s] for s in part.column(1).to_pylist()], dtype=np.int64) + k * (part.column(2).to_numpy() & 1)
            cell, text = _gram_counts(part.column(0).to_pylist())
            counts += np.bincount(np.concatenate([who[text] * cells + cell, who * cells + cells - 1]), minlength=len(counts))

    halves = corpus_counts(rows, add, 2 * k * cells).reshape(2, k, cells).astype(np.float64)
    shared = docs.sparkSession.sparkContext.broadcast([_likelihoods(h) for h in halves])

    def lose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost = np.zeros(len(TEMPERATURES))
        for batch in batches:
            for b in range(0, batch.num_rows, 1000):
                part = batch.slice(b, 1000)
                half = part.column(2).to_numpy() & 1
                own = np.array([place[s] for s in part.column(1).to_pylist()], dtype=np.int64)
                texts = part.column(0).to_pylist()
                for side in (0, 1):
                    at = (half == side).nonzero()[0]
                    if len(at):
                        w = shared.value[1 - side]
                        score = _scores([texts[i] for i in at], w)
                        for i, t in enumerate(TEMPERATURES):
                            lost[i] -= np.log(_posterior(score, w[-1], t)[np.arange(len(at)), own[at]] + 1e-30).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(TEMPERATURES)), pa.int32()), pa.array(lost)], names=["i", "lost"])

    few = rows.where(F.col("draw") < int((1 << 30) * min(1.0, CALIBRATED_ON / max(1.0, halves[:, :, -1].sum()))))
    lost = {r["i"]: r["lost"] for r in few.mapInArrow(lose, "i int, lost double").groupBy("i").agg(F.sum("lost").alias("lost")).collect()}
    return _likelihoods(halves.sum(axis=0)), TEMPERATURES[min(lost, key=lambda i: (lost[i], i))] if lost else 0.0


def memberships(docs: DataFrame, spark: SparkSession, sources: list[str], caps: np.ndarray, folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(doc_id, source, tokens, posterior, cap, rate) of every row: its length in tokens, its share in each domain, the most copies of it, and a first rate.

    The posterior of every document comes from the classifier. The source that a document
    names is evidence like its words: it is that of its domain but for LABEL_NOISE of the
    documents, which are spread over the others; without a source of the list the words
    alone decide. ``cap`` is that of the source, without one the whole part of the mean over
    the domains. One pass.
    """
    model = spark.sparkContext.broadcast(learn_domains(docs, sources))
    ranks = share_ranks(spark, folder, name)
    place, k = {s: i for i, s in enumerate(sources)}, len(sources)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, (w, temperature) = vocabulary(ranks.value), model.value
        for batch in batches:
            for b in range(0, batch.num_rows, 1000):
                part = batch.slice(b, 1000)
                texts = [t or "" for t in part.column(2).to_pylist()]
                tokens = lengths(v, texts)
                own = np.array([place.get(s, -1) for s in part.column(1).to_pylist()], dtype=np.int64)
                named = own >= 0
                prior = np.tile(w[-1].astype(np.float64), (len(texts), 1))
                if k > 1:
                    prior[named] += np.log(LABEL_NOISE / (k - 1))
                    prior[named, own[named]] += np.log((1 - LABEL_NOISE) * (k - 1) / LABEL_NOISE)
                p = _posterior(_scores(texts, w, temperature), prior, temperature)
                cap = np.where(named, caps[own], np.floor(p @ caps + 1e-9))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(tokens, pa.int64()), pa.array(list(p), pa.list_(pa.float64())), pa.array(cap), pa.array(np.minimum(1.0, cap))], names=["doc_id", "source", "tokens", "posterior", "cap", "rate"]
                )

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", canonical_word("source").alias("source"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, source string, tokens bigint, posterior array<double>, cap double, rate double")


def _stepped(batch: pa.RecordBatch, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(posteriors, rates) of a batch after the given gradient steps, each projected to 0..cap."""
    p = batch.column("posterior").flatten().to_numpy().reshape(batch.num_rows, -1)
    cap, r = batch.column("cap").to_numpy(), batch.column("rate").to_numpy()
    for g in steps:
        r = np.clip(r - p @ g, 0.0, cap)
    return p, r


def fit_rates(members: DataFrame, goal: np.ndarray, most_steps: int = 60, tolerance: float = 1e-4, judged: np.ndarray | None = None) -> tuple[DataFrame, np.ndarray]:
    """(members with their rates, totals): projected-gradient least squares for nonnegative document rates.

    Minimises the squared misfit of the domains' expected token totals to ``goal``, in units
    of the tokens that the domains have and share, over rates between 0 and a document's cap.
    Every step is one aggregate over all documents that sends some numbers per pair of
    domains; after every CARRIED_AFTER steps the rates are written, so that no step is worked
    out more often than that. The misfit of the ``judged`` domains (by default all) says when
    to stop: when it is nothing, or no step makes it much smaller (the targets can't be
    reached). Where it is still falling after ``most_steps``, a warning tells the misfit.
    """
    k = len(goal)
    judged = np.ones(k, dtype=bool) if judged is None else judged

    def totals_after(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((k, k + 1))
            for batch in batches:
                if batch.num_rows:
                    p, r = _stepped(batch, steps)
                    t = batch.column("tokens").to_numpy().astype(np.float64)
                    sums += (t[:, None] * p).T @ np.column_stack([r, p])
            yield pa.RecordBatch.from_arrays([pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())], names=["i", "x"])

        sums = np.zeros(k * (k + 1))
        for r in members.select("tokens", "posterior", "cap", "rate").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
            sums[r["i"]] = r["x"]
        sums = sums.reshape(k, k + 1)
        return sums[:, 0], sums[:, 1:]

    def carried(steps: list[np.ndarray]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield batch.set_column(batch.schema.get_field_index("rate"), "rate", pa.array(_stepped(batch, steps)[1]))

        return members.mapInArrow(run, members.schema)

    steps: list[np.ndarray] = []
    got, shared = totals_after(steps)
    # a ridge for domains that no document belongs to
    scale = shared + np.eye(k) * max(1.0, shared.trace()) * 1e-9
    misfit = np.abs(got - goal)[judged].max(initial=0.0)
    for _ in range(most_steps):
        if len(steps) == CARRIED_AFTER:
            before, members = members, cut(carried(steps), "members")
            drop_cut(before)
            steps = []
        steps.append(np.linalg.solve(scale, np.where(judged, got - goal, 0.0)))
        got, _ = totals_after(steps)
        last, misfit = misfit, np.abs(got - goal)[judged].max(initial=0.0)
        if misfit <= tolerance * max(1.0, goal.sum()) or abs(last - misfit) <= 10 * tolerance * misfit:
            break
    else:
        warnings.warn(f"the rates miss a target by {misfit:.0f} of {goal.sum():.0f} tokens after {most_steps} steps", stacklevel=2)
    return carried(steps), got


def mix(docs: DataFrame, mix_targets: DataFrame, spark: SparkSession, total_tokens: float | None = None, folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(doc_id, source, domain, tokens, rate, copies) of every row of ``docs``.

    ``rate`` is the expected number of copies, at most the cap of the document's source (see
    ``memberships``); ``copies`` is its whole part, and one more where a hash of the id
    decides so, such that the tokens of a domain add up to its rates; never above the cap.
    ``domain`` is the source, or the likeliest one where the source is missing or not in the
    targets.

    ``total_tokens`` is the size of the mix; by default it is the largest at which every
    source that documents with tokens name reaches its share without exceeding its cap, so
    that only sources without any documents miss theirs (the little that the classifier gives
    them of other documents doesn't count). Where no document names a source of the targets,
    the posteriors decide. With a larger size the sources that can't reach theirs stay at
    their cap, and ``shares`` reports what came of it.

    Null and empty texts have no tokens and rate 0. Repeated ids are mixed row by row. Empty
    targets give rate 0 for all.
    """
    targets = targets_of(mix_targets)
    sources = [t[0] for t in targets]
    if not sources:
        return docs.select("doc_id", canonical_word("source").alias("source"), F.lit(None).cast("string").alias("domain"), F.lit(0).cast("bigint").alias("tokens"), F.lit(0.0).alias("rate"), F.lit(0).alias("copies"))
    share, caps = np.array([t[1] for t in targets]), np.array([t[2] for t in targets], dtype=np.float64)
    members = cut(memberships(docs, spark, sources, caps, folder, name), "members")
    own = F.when(F.col("source") == F.get(F.array(*map(F.lit, sources)), F.col("k")), F.col("tokens"))
    held = members.select(F.posexplode("posterior").alias("k", "p"), "tokens", "source").groupBy("k").agg(F.sum(F.col("p") * F.col("tokens")).alias("t"), F.sum(own).alias("own")).collect()
    have, named = np.zeros(len(sources)), np.zeros(len(sources))
    for r in held:
        have[r["k"]], named[r["k"]] = r["t"], r["own"] or 0
    has = named if named.any() else have
    if total_tokens is None:
        total_tokens = float((has * caps / share)[has > 0].min()) if has.any() else 0.0
    fitted, _ = fit_rates(members, share * total_tokens, judged=has > 0 if has.any() else None)
    likeliest = F.get(F.array(*map(F.lit, sources)), F.array_position("posterior", F.array_max("posterior")) - 1)
    rate = F.when(F.col("tokens") > 0, F.col("rate")).otherwise(0.0)
    domain = F.when(F.col("source").isin(*sources), F.col("source")).otherwise(likeliest)
    rated = cut(fitted.select("doc_id", "source", "tokens", domain.alias("domain"), rate.alias("rate"), "cap"), "rated")
    broken = F.col("rate") - F.floor(F.col("rate") + 1e-9)
    draw = (F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    drawn = rated.withColumn("broken", F.greatest(broken, F.lit(0.0))).withColumn("place", F.when(F.col("broken") > 0, draw / F.col("broken")))
    edges = spark.createDataFrame(_edges(drawn), "domain string, edge double")
    copies = F.least(F.col("cap"), F.floor(F.col("rate") + 1e-9) + F.when(F.col("place") < F.coalesce("edge", F.lit(1.0)), 1).otherwise(0)).cast("int")
    return drawn.join(F.broadcast(edges), "domain", "left").select("doc_id", "source", "domain", "tokens", F.round("rate", 6).alias("rate"), copies.alias("copies"))


def _edges(drawn: DataFrame, buckets: int = 2048) -> list[tuple[str, float]]:
    """For each domain the place below which its documents get one copy more.

    A document's place is its draw in units of the broken part of its rate, so that below 1 it
    gets one more with that probability. The edge is set near 1 where the tokens of those
    documents add up to the broken parts of all, so that rounding hardly moves the shares. At
    most 4 * ``buckets`` numbers a domain reach the driver.
    """
    bucket = F.least(F.lit(4 * buckets), F.floor(F.col("place") * buckets))
    rows = drawn.where(F.col("broken") > 0).groupBy("domain", bucket.alias("bucket")).agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.col("broken")).alias("due")).orderBy("domain", "bucket").collect()
    out = []
    for domain in sorted({r["domain"] for r in rows}):
        own = [r for r in rows if r["domain"] == domain]
        run = np.concatenate([[0.0], np.cumsum([r["t"] for r in own])])
        cut_at = int(np.abs(run - sum(r["due"] for r in own)).argmin())
        out.append((domain, float(own[cut_at]["bucket"] / buckets) if cut_at < len(own) else float(4 * buckets)))
    return out


def shares(mixed: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, expected_share, misfit, documents, tokens, most_copies, reached) for every target.

    ``actual_share`` is of the tokens of the copies, ``expected_share`` of the rates, ``misfit``
    what the rates miss the target by;
    ``reached`` says whether the actual share is within a hundredth of the target or 2 %
    of it. Sources without documents have shares 0.
    """
    by = mixed.groupBy(F.col("domain").alias("source")).agg(
        F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.sum(F.col("rate") * F.col("tokens")).alias("expected"), F.count_if(F.col("copies") > 0).alias("documents"), F.max("copies").alias("most_copies")
    )
    goal = mix_targets.select(canonical_word("source").alias("source"), "target_share")
    whole = by.agg(F.sum("tokens").alias("all"), F.sum("expected").alias("all_expected"))
    rows = goal.join(by, "source", "left").join(F.broadcast(whole))
    actual = F.coalesce(F.try_divide("tokens", "all"), F.lit(0.0))
    expected = F.coalesce(F.try_divide("expected", "all_expected"), F.lit(0.0))
    return rows.select(
        "source",
        "target_share",
        F.round(actual, 6).alias("actual_share"),
        F.round(expected, 6).alias("expected_share"),
        F.round(expected - F.col("target_share"), 6).alias("misfit"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        (F.abs(actual - F.col("target_share")) <= F.greatest(F.lit(0.01), F.col("target_share") * 0.02)).alias("reached"),
    )
