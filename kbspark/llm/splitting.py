"""Splitting of oversized texts at natural boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kbspark.functions.text import canonical_extension, canonical_id
from kbspark.plans.skew import small

#: Cuts by kind, best first: pattern whose match start (or end) is the cut, and its penalty.
HEADING, MARK, BLANK, LINE, SENTENCE, HARD = "heading", "mark", "blank line", "line", "sentence", "hard"
PENALTY = {HEADING: 0.0, MARK: 0.0, BLANK: 0.02, LINE: 0.06, SENTENCE: 0.12, HARD: 0.5}
_EOL = r"(?:\r\n|\n|\r| | |\x85|\x0b)"
_STARTS = [
    (HEADING, re.compile(rf"(?:^|(?<=[\n\r  \x85\x0b]))(?=#{{1,6}}[ \t]|第[一二三四五六七八九十百0-9]+[章节条])")),
    (MARK, re.compile(r"(?=\[\[[^\[\]\n]{1,120}\]\]|\f|(?<=[\n\r])-{3,} ?(?:[Pp]age|[Ss]lide|第)|(?<=[\n\r])(?:[Pp]age|[Ss]lide|Seite) \d+\b)")),
]
_ENDS = [
    (BLANK, re.compile(rf"{_EOL}(?:[ \t　]*{_EOL})+")),
    (LINE, re.compile(_EOL)),
    (SENTENCE, re.compile(r"[。！？；…]+[”’」』）)\"']*|[.!?]+[\"'”’)\]]*(?=\s)")),
]
_RANK = {k: i for i, k in enumerate(PENALTY)}
#: Never cut before these: they belong to the character before them.
_JOINED = re.compile(r"[̀-ͯ‍︀-️\U0001f3fb-\U0001f3ff\n]")


def boundaries(text: str) -> dict[int, str]:
    """Positions at which ``text`` may be cut naturally, each with its best kind."""
    found: dict[int, str] = {}
    for kind, pattern in _STARTS:
        for m in pattern.finditer(text):
            found.setdefault(m.start(), kind)
    for kind, pattern in _ENDS:
        for m in pattern.finditer(text):
            p = m.end()
            if _RANK[found.get(p, HARD)] > _RANK[kind]:
                found[p] = kind
    found.pop(0, None)
    found.pop(len(text), None)
    return found


def cut_ends(text: str, limit: int, overlap: int) -> tuple[list[int], list[str]]:
    """Ends of the pieces of ``text`` and the kind of each cut (the last: ``end``).

    Dynamic programming over boundary positions: a piece that ends at ``e`` began ``overlap``
    before the end of the piece ahead of it, and costs the penalty of its cut plus the square
    of its relative distance from the even size. Only where no natural boundary is in reach
    of the last cut are hard cuts allowed, evenly spaced over the stretch without boundaries.
    """
    n = len(text)
    overlap = max(0, min(overlap, limit - 1))
    step = limit - overlap  # how far one piece gets beyond the cut ahead of it
    if n <= limit:
        return [n], ["end"]
    # a piece begins ``overlap`` before its cut, so that the first cut lies beyond ``overlap``
    kinds = {p: k for p, k in boundaries(text).items() if p > overlap}
    natural = [overlap, *sorted(kinds), n]
    spots = [(overlap, "start")]
    for a, b in zip(natural[:-1], natural[1:]):
        last = a
        if (gap := b - a) > step:
            count = -(-gap // step)
            for i in range(1, count):
                p = min(a + gap * i // count, last + step)
                while p - last > 1 and _JOINED.match(text, p):
                    p -= 1
                spots.append((p, HARD))
                last = p
            while b - last > step:  # cuts that were moved may leave too long a rest
                last += step
                spots.append((last, HARD))
        spots.append((b, kinds.get(b, "end")))
    at = np.array([p for p, _ in spots])
    hard = np.array([k == HARD for _, k in spots])
    penalty = np.array([PENALTY.get(k, 0.0) for _, k in spots])
    even = (n - overlap) / -(-(n - overlap) // step)
    low = np.searchsorted(at, at - step)  # first spot from which this one can be reached
    natural_at = at[~hard]
    following = natural_at[np.minimum(np.searchsorted(natural_at, at, side="right"), len(natural_at) - 1)]
    stuck = following > at + step
    best = np.full(len(at), np.inf)
    best[0] = 0.0
    back = np.zeros(len(at), dtype=np.int64)
    for i in range(1, len(at)):
        j = np.arange(low[i], i)
        cost = best[j] + ((at[i] - at[j] - even) / even) ** 2
        if hard[i]:
            cost = np.where(stuck[j], cost, np.inf)
        k = int(np.argmin(cost))
        best[i] = cost[k] + penalty[i]
        back[i] = j[k]
    ends, cuts, i = [], [], len(at) - 1
    while i > 0:
        ends.append(int(at[i]))
        cuts.append(spots[i][1])
        i = int(back[i])
    return ends[::-1], cuts[::-1]


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """(start, end, kind of the cut at the end) of the pieces, in order."""
    overlap = max(0, min(overlap, limit - 1))
    ends, cuts = cut_ends(text, limit, overlap)
    starts = [0, *[e - overlap for e in ends[:-1]]]
    return list(zip(starts, ends, cuts))


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for begin in range(0, len(rows), 64):
            out = []
            for r in rows.iloc[begin : begin + 64].itertuples(index=False):
                for no, (s, e, cut) in enumerate(pieces(r.content, int(r.max_chars), int(r.overlap_chars))):
                    out.append((r.source_id, r.extension, r.content_key, no, s, e, cut, r.content[s:e]))
            if out:
                yield pd.DataFrame(out, columns=["source_id", "extension", "content_key", "piece_no", "start_pos", "end_pos", "cut", "piece"])


def split_oversized(texts: DataFrame, limits: DataFrame, least_limit: int = 1) -> DataFrame:
    """Pieces of every content that is longer than the max_chars of its extension.

    ``texts`` has source_id, extension and content (other columns are ignored); ``limits``
    has extension, max_chars and overlap_chars, the row ``*`` for all other extensions.
    Returns (source_id, extension, content_key, piece_no, start_pos, end_pos, cut, piece), the
    key a hash of the content, positions in code points; consecutive pieces share exactly overlap_chars characters, and the pieces
    without what they share with the one ahead give the content again.

    Null, empty and short contents have no pieces. Rows without a limit (no row ``*``, a
    null or non-positive max_chars) are left whole. An overlap is at most max_chars - 1, a
    null one is 0. Of limits given twice the smallest counts. A content delivered again
    under one id is split once; a null id stays null. Only oversized rows leave the JVM, in
    Arrow batches, and are spread evenly before.
    """
    rule = limits.select(
        canonical_extension("extension").alias("extension"), F.col("max_chars").cast("bigint").alias("max_chars"), F.coalesce(F.col("overlap_chars").cast("bigint"), F.lit(0)).alias("overlap_chars")
    ).where(F.col("max_chars") >= least_limit)
    rule = rule.groupBy("extension").agg(F.min(F.struct("max_chars", "overlap_chars")).alias("rule"))
    rest = rule.where(F.col("extension") == "*").select(F.col("rule").alias("rest"))
    rows = texts.select(canonical_id("source_id").alias("source_id"), canonical_extension("extension").alias("extension"), "content").where(F.col("content").isNotNull())
    ruled = rows.join(small(rule.where(F.col("extension") != "*")), "extension", "left").join(small(rest), F.lit(True), "left")
    long = ruled.withColumn("rule", F.coalesce("rule", "rest")).where(F.length("content") > F.col("rule.max_chars"))
    once = long.select("source_id", "extension", F.sha2("content", 256).alias("content_key"), "content", "rule.max_chars", "rule.overlap_chars").dropDuplicates(["source_id", "extension", "content_key"])
    return once.mapInPandas(_split, "source_id string, extension string, content_key string, piece_no int, start_pos bigint, end_pos bigint, cut string, piece string")


def oversized_ids(split: DataFrame) -> DataFrame:
    """Distinct ids of the records that were split."""
    return split.where((F.col("piece_no") == 1) & F.col("source_id").isNotNull()).select("source_id").distinct()


def rebuilt(split: DataFrame) -> DataFrame:
    """(source_id, extension, text_hash, shared, longest) of every split content, from its pieces alone.

    The pieces without what they share with the one ahead, put together; ``shared`` are the
    characters that consecutive pieces have in common (null where they differ), ``longest``
    those of the largest piece. The pieces of one content are few and meet in one row.
    """
    own = Window.partitionBy("source_id", "extension", "content_key").orderBy("piece_no")
    rows = split.withColumn("before", F.lag("end_pos").over(own)).withColumn("common", F.col("before") - F.col("start_pos"))
    part = F.struct("piece_no", F.expr("substring(piece, int(coalesce(common, 0)) + 1)").alias("part"))
    one = rows.groupBy("source_id", "extension", "content_key").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.min("common").alias("least"), F.max("common").alias("most"), F.max(F.length("piece")).alias("longest"))
    return one.select("source_id", "extension", F.sha2(F.array_join("parts.part", ""), 256).alias("text_hash"), F.when(F.col("least") == F.col("most"), F.col("least")).alias("shared"), "longest")
