"""Consolidating pairwise matches into groups by low-diameter decomposition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbspark.functions.text import blank_to_null, canonical_id, canonical_word
from kbspark.plans.lineage import cut, drop_cut
from kbspark.plans.skew import small

#: Verdicts that link two records.
CONFIRMED = "confirmed"
MATCH_TYPES = ("完全重复", "版本关系")


def current_verdicts(verdicts: DataFrame) -> DataFrame:
    """(source_id, target_id, status, type) of the latest row of each relation_id.

    Rows without relation_id can't supersede each other and all count. Of rows verified at
    the same time the greatest counts. The rows of one relation meet in a partial aggregate
    before the shuffle.
    """
    v = verdicts.select(
        blank_to_null("relation_id").alias("relation_id"),
        F.struct(
            F.col("verified_at"),
            canonical_id("source_id").alias("source_id"),
            canonical_id("target_id").alias("target_id"),
            canonical_word("verification_status").alias("status"),
            canonical_word("verified_relation_type").alias("type"),
        ).alias("v"),
    )
    latest = v.where(F.col("relation_id").isNotNull()).groupBy("relation_id").agg(F.max("v").alias("v")).select("v.*")
    return latest.unionByName(v.where(F.col("relation_id").isNull()).select("v.*")).drop("verified_at")


def matches(verdicts: DataFrame) -> DataFrame:
    """(a, b) of the pairs of different records that a current verdict links, both ids given."""
    v = current_verdicts(verdicts).where((F.col("status") == CONFIRMED) & F.col("type").isin(*MATCH_TYPES))
    return v.where(F.col("source_id") != F.col("target_id")).select(F.col("source_id").alias("a"), F.col("target_id").alias("b"))


#: Edges of one vertex that are joined in one piece; a vertex with more is met in several pieces.
SPLIT = 100_000
#: Rounds of growth between two written tables.
ROUNDS = 3


def _start(vertex: str, level: int, beta: float) -> F.Column:
    """Exponential shift of a vertex, drawn from its id and the level; the whole of the distribution."""
    u = (F.pmod(F.xxhash64(F.col(vertex), F.lit(level)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(u) / beta


def _adjacency(edges: DataFrame, level: int, beta: float, split: int) -> tuple[DataFrame, bool]:
    """(src, dst, part, parts, left) of the edges (a, b) both ways and of a loop at every vertex; whether any vertex is in parts.

    ``left`` is the shift of the vertex, on loops only. A vertex with more than ``split``
    edges falls into ``parts``, and each of its edges into one of them by the other end, so
    that no task holds all edges of a hub. There are at most 2/split as many such vertices as
    edges.
    """
    ways = edges.select(F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))).alias("e")).select("e.*")
    degree = ways.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    loops = degree.select("src", F.col("src").alias("dst"), F.lit(0).alias("part"), F.ceil(F.col("n") / split).cast("int").alias("parts"), _start("src", level, beta).alias("left"))
    hubs = cut(degree.where(F.col("n") > split).select("src", F.ceil(F.col("n") / split).cast("int").alias("k")), "hubs")
    any_hub = not hubs.isEmpty()
    k = F.lit(1)
    if any_hub:
        ways, k = ways.join(small(hubs), "src", "left"), F.coalesce("k", F.lit(1))
    links = ways.select("src", "dst", F.pmod(F.xxhash64("dst"), k).cast("int").alias("part"), F.lit(0).alias("parts"), F.lit(None).cast("double").alias("left"))
    out = cut(links.unionByName(loops), "adjacency")
    drop_cut(hubs)
    return out, any_hub


def _grown(adjacency: DataFrame, parted: bool) -> DataFrame:
    """(id, cluster, parts) once no cluster gets anywhere sooner than another.

    Every vertex starts a cluster at a time that is earlier the larger its exponential shift
    is. In each round a cluster reaches the neighbours of its members, and a vertex keeps the
    cluster that gets there first. A round is one join with the adjacency and one aggregate;
    its loops carry what a vertex has already, so that the state is named once a round and
    the plan grows in proportion to the rounds. After every few rounds the state is written
    and looked at: it ends when the last round moved nothing.
    """
    best = F.struct("left", F.col("src").alias("cluster"))
    state = adjacency.where(F.col("src") == F.col("dst")).select(F.col("src").alias("id"), "parts", best.alias("best"))
    links = adjacency.select("src", "dst", "part")
    before: DataFrame | None = None
    while True:
        for _ in range(ROUNDS):
            # every part of a hub meets the hub's state
            met = state.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")) if parted else state
            own = F.col("src") == F.col("dst")
            moved = links.join(met.withColumnRenamed("id", "src"), ["src", "part"] if parted else ["src"]).select(
                F.col("dst").alias("id"),
                F.when(own, F.col("parts")).alias("parts"),
                F.struct((F.col("best.left") - F.when(own, 0.0).otherwise(1.0)).alias("left"), F.col("best.cluster").alias("cluster")).alias("best"),
                F.when(own, F.col("best.cluster")).alias("had"),
            )
            state = moved.where(F.col("best.left") >= 0).groupBy("id").agg(F.max("parts").alias("parts"), F.max("best").alias("best"), F.max("had").alias("had"))
        written = cut(state, "grown")
        if before is not None:
            drop_cut(before)
        if written.where(F.col("had") != F.col("best.cluster")).isEmpty():
            return written.select("id", "best.cluster", "parts")
        before, state = written, written.drop("had")


def _renamed(edges: DataFrame, names: DataFrame, parted: bool) -> DataFrame:
    """(a, b) of the edges between different clusters, by the names of the clusters; hubs in parts as in ``_adjacency``."""
    for end, other in (("a", "b"), ("b", "a")):
        to = names.select(F.col("id").alias(end), F.col("name").alias(f"n{end}"), "parts")
        if parted:
            known = small(to.where("parts > 1").select(end, F.col("parts").alias("k")))
            edges = edges.join(known, end, "left").withColumn("part", F.pmod(F.xxhash64(other), F.coalesce("k", F.lit(1))).cast("int")).drop("k")
            to = to.select(end, f"n{end}", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
            edges = edges.join(to, [end, "part"]).drop("part")
        else:
            edges = edges.join(to.drop("parts"), end)
    return edges.where(F.col("na") != F.col("nb")).select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct()


def connected_groups(links: DataFrame, beta: float = 0.2, split: int = SPLIT) -> DataFrame:
    """(id, group_id) for every id in ``links`` (a, b); group_id is the smallest id linked to it.

    Low-diameter decomposition: on each level clusters grow from exponentially shifted start
    times, every cluster becomes one vertex named by the smallest of its members, and the
    edges that are left between clusters make the graph of the next level, until none are
    left; the assignments of the levels are composed from the last to the first. Since names
    are smallest members, the last name of a record is the smallest id of its group, and no
    group is gathered anywhere. An edge stays between clusters with a probability of about
    ``beta``, so that levels number about log(edges) / log(1 / beta) and rounds of a level at
    most about log(vertices) / beta. Every level is written to the shared folder, and what no
    later step reads is deleted. All aggregates combine before their shuffle; hubs are joined
    in parts, the joins by cluster are split at run time (adaptive skew joins).

    Links with a missing end or to itself link nothing; repeated and turned links count once;
    empty input gives no rows. An id that is only in such links is not in the result.
    """
    clean = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = cut(clean.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    levels: list[DataFrame] = []
    while not levels or not edges.isEmpty():
        adjacency, parted = _adjacency(edges, len(levels), beta, split)
        grown = _grown(adjacency, parted)
        names = grown.groupBy("cluster").agg(F.min("id").alias("name"))
        levels.append(cut(grown.join(names, "cluster").select("id", "name", "parts"), "level"))
        left = cut(_renamed(edges, levels[-1], parted), "links")
        for done in (edges, adjacency, grown):
            drop_cut(done)
        edges = left
    drop_cut(edges)
    groups = levels[-1].select("id", F.col("name").alias("group_id"))
    for below in reversed(levels[:-1]):
        # a name without edges on the level above is final
        composed = below.join(groups.withColumnRenamed("id", "name"), "name", "left").select("id", F.coalesce("group_id", "name").alias("group_id"))
        above, groups = groups, cut(composed, "groups")
        for done in (below, above):
            drop_cut(done)
    return groups


def verdict_groups(verdicts: DataFrame) -> DataFrame:
    """(source_id, group_id) of every record in at least one match with another record."""
    return connected_groups(matches(verdicts)).select(F.col("id").alias("source_id"), "group_id")
