"""Recall of relations between documents: each rule is one join or one grouping on a key.

Rules on a shared key return *memberships* (rule, bucket, source_id, members), one row per
document and key, however large a bucket is; ``pairs_within`` expands the buckets up to a
size into pairs, and keeps each larger one as links of its members to its smallest member,
so that a key that a third of all documents share costs one row per document.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbspark.functions.text import blank_to_null
from kbspark.functions.titles import NODE_LINK, STABLE_ID, TITLE_CITED, VERSION_MARK, business_ids, folded, title_key
from kbspark.operators.documents import parent_folder
from kbspark.operators.merging import Blocks, in_blocks
from kbspark.operators.neighbours import nearest_documents
from kbspark.operators.order import numbered
from kbspark.plans.lineage import batches_of_files, cut, drop_cut, files_in_order

#: Largest buckets that are expanded into pairs.
PAIR_LIMIT = 50
#: Roles that complete each other.
ROLE_PAIRS = (("制度", "流程"), ("制度", "模板"), ("制度", "案例"), ("规范", "执行流程"), ("规范", "模板"), ("流程", "模板"), ("流程", "案例"), ("方案", "交付物"), ("输入", "执行流程"))


def memberships(rows: DataFrame, rule: str, least: int = 2) -> DataFrame:
    """(rule, bucket, source_id, members) of the distinct (bucket, source_id) in buckets of at least ``least``."""
    own = rows.where(F.col("bucket").isNotNull() & (F.col("bucket") != "")).select("bucket", "source_id").distinct()
    size = own.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") >= least)
    return own.join(size, "bucket").select(F.lit(rule).alias("rule"), "bucket", "source_id", "members")


def pairs_within(members: DataFrame, limit: int = PAIR_LIMIT) -> DataFrame:
    """(rule, bucket, source_id, target_id, form): all pairs of the buckets up to ``limit``; of larger ones links to the smallest member."""
    few = members.where(F.col("members") <= limit)
    other = few.select("rule", "bucket", F.col("source_id").alias("target_id"))
    pairs = few.join(other, ["rule", "bucket"]).where(F.col("source_id") < F.col("target_id")).select("rule", "bucket", "source_id", "target_id", F.lit("pair").alias("form"))
    many = members.where(F.col("members") > limit)
    first = many.groupBy("rule", "bucket").agg(F.min("source_id").alias("first"))
    stars = many.join(first, ["rule", "bucket"]).where(F.col("source_id") != F.col("first")).select("rule", "bucket", F.col("first").alias("source_id"), F.col("source_id").alias("target_id"), F.lit("member").alias("form"))
    return pairs.unionByName(stars)


def same_content(docs: DataFrame) -> DataFrame:
    """Documents with the same content."""
    return memberships(docs.select(F.when(F.trim("content") != "", F.sha2("content", 256)).alias("bucket"), "source_id"), "same content")


def same_title(docs: DataFrame) -> DataFrame:
    """Versions of one title: at least one member must show a version in its name or signals."""
    rows = docs.select(title_key(F.col("file_name")).alias("bucket"), "source_id", (F.col("file_name").rlike(VERSION_MARK) | (F.size(F.coalesce("version_signals", F.array())) > 0)).alias("marked")).where(F.length("bucket") >= 4)
    marked = rows.where("marked").select("bucket").distinct()
    return memberships(rows.join(marked, "bucket", "left_semi"), "same title")


def same_business_id(docs: DataFrame) -> DataFrame:
    """Documents that name the same project or ticket."""
    text = F.concat_ws("\n", "file_name", "content")
    return memberships(docs.select(F.explode(business_ids(text)).alias("bucket"), "source_id"), "same business id")


def same_folder(docs: DataFrame) -> DataFrame:
    """Documents of one folder."""
    return memberships(docs.select(parent_folder(F.col("source_path")).alias("bucket"), "source_id"), "same folder")


def linked_nodes(docs: DataFrame) -> DataFrame:
    """(source_id, target_id): links in the content to the node of another document."""
    found = docs.select("source_id", F.explode(F.array_distinct(F.regexp_extract_all("content", F.lit(NODE_LINK), 1))).alias("node_id"))
    nodes = docs.where(blank_to_null("node_id").isNotNull()).groupBy("node_id").agg(F.min("source_id").alias("target_id"))
    return found.join(nodes, "node_id").where(F.col("source_id") != F.col("target_id")).select("source_id", "target_id").distinct()


def mentioned_ids(docs: DataFrame) -> DataFrame:
    """(source_id, target_id): ids of other documents in the content."""
    found = docs.select("source_id", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("content", F.lit(STABLE_ID), 0), F.upper))).alias("target_id"))
    return found.where(F.col("source_id") != F.col("target_id")).join(docs.select(F.col("source_id").alias("target_id")), "target_id", "left_semi").select("source_id", "target_id")


def cited_titles(docs: DataFrame) -> DataFrame:
    """(source_id, target_id): titles that are cited, in the content or as explicit references, and that one document only has."""
    cited = F.array_distinct(F.concat(F.coalesce(F.regexp_extract_all("content", F.lit(TITLE_CITED), 1), F.array()), F.coalesce(F.transform("explicit_references", lambda r: r["target_text"]), F.array())))
    found = docs.select("source_id", F.explode(cited).alias("title")).select("source_id", title_key(F.col("title")).alias("key")).where(F.col("key") != "").distinct()
    titles = docs.select(title_key(F.col("file_name")).alias("key"), "source_id").where(F.col("key") != "").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("source_id").alias("target_id")).where("n = 1")
    return found.join(titles, "key").where(F.col("source_id") != F.col("target_id")).select("source_id", "target_id").distinct()


def output_to_input(docs: DataFrame) -> DataFrame:
    """(bucket, source_id, side): documents by what they put out and take in; links are between the sides of a bucket."""
    sides = [docs.select(folded(F.col("x")).alias("bucket"), "source_id", F.lit(side).alias("side")) for side, docs in (("output", docs.withColumn("x", F.explode("outputs"))), ("input", docs.withColumn("x", F.explode("inputs"))))]
    return _on_both_sides(sides[0].unionByName(sides[1]).where(F.length("bucket") >= 2).distinct())


def _on_both_sides(rows: DataFrame) -> DataFrame:
    """``rows`` (bucket, source_id, side) of the buckets with both sides, with how many rows each has."""
    both = rows.groupBy("bucket").agg(F.count_if(F.col("side") == "output").alias("outputs"), F.count_if(F.col("side") == "input").alias("inputs")).where("outputs > 0 and inputs > 0")
    return rows.join(both, "bucket").select("bucket", "source_id", "side", "outputs", "inputs")


def complementary_roles(docs: DataFrame) -> DataFrame:
    """(bucket, source_id, role, partners): documents that share a business object with ones in a role that completes theirs.

    ``partners`` counts them by role, from the numbers of documents per object and role, so
    that no pairs are made.
    """
    rows = docs.select("source_id", F.coalesce(blank_to_null("document_role"), blank_to_null("page_type_candidate")).alias("role"), F.explode("business_objects").alias("x"))
    rows = rows.select(folded(F.col("x")).alias("bucket"), "source_id", "role").where((F.col("bucket") != "") & F.col("role").isNotNull()).distinct()
    both = [(a, b) for a, b in ROLE_PAIRS] + [(b, a) for a, b in ROLE_PAIRS]
    per = rows.groupBy("bucket", "role").agg(F.count(F.lit(1)).alias("n"))
    # a role completes another if each contains one side of a pair
    fits = F.exists(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in both]), lambda p: F.contains(F.col("role"), p["a"]) & F.contains(F.col("other"), p["b"]))
    partners = per.select("bucket", "role").join(per.select("bucket", F.col("role").alias("other"), "n"), "bucket").where(fits)
    partners = partners.groupBy("bucket", "role").agg(F.sum(F.when(F.col("other") == F.col("role"), F.col("n") - 1).otherwise(F.col("n"))).alias("partners"))
    return rows.join(partners, ["bucket", "role"]).where("partners > 0").select("bucket", "source_id", "role", "partners")


#: Strength of the rules in the merged evidence.
STRENGTH = {"linked node": ("strong", 1.0), "mentioned id": ("strong", 1.0), "same content": ("strong", 1.0), "cited title": ("medium", 0.72), "same title": ("medium", 0.75), "same business id": ("medium", 0.68), "same folder": ("weak", 0.2)}
#: The same with the rules that only ``whole_evidence`` has; the weight of near words is their cosine.
WHOLE_STRENGTH = STRENGTH | {"output to input": ("medium", 0.74), "complementary roles": ("medium", 0.66), "near words": ("weak", 0.0)}
#: Documents of one side of a bucket that are joined in one piece.
BLOCK = 512
#: Bounds of buckets in the source program. No merge has them: every bucket is whole there.
BOUNDS = {"same title": 30, "same business id": 50, "same folder": 50}


def _links(docs: DataFrame) -> DataFrame:
    """(source_id, target_id, rule) of the rules that find pairs one by one."""
    parts = [linked_nodes(docs).withColumn("rule", F.lit("linked node")), mentioned_ids(docs).withColumn("rule", F.lit("mentioned id")), cited_titles(docs).withColumn("rule", F.lit("cited title"))]
    return reduce(DataFrame.unionByName, parts)


def _members(docs: DataFrame) -> DataFrame:
    """The memberships of all rules on a shared key, written once: each is a search through all contents."""
    return cut(reduce(DataFrame.unionByName, [same_content(docs), same_title(docs), same_business_id(docs), same_folder(docs)]), "members")


def evidence(docs: DataFrame) -> DataFrame:
    """(source_id, target_id, rule): what seven rules say about pairs, unordered rules with the smaller id first; ``whole_evidence`` has all pairs of large buckets."""
    return _links(docs).unionByName(pairs_within(_members(docs)).select("source_id", "target_id", "rule").distinct())


def every_pair(members: DataFrame) -> DataFrame:
    """(rule, source_id, target_id) of all pairs of each bucket, the smaller id first, as often as both share one; a large bucket is joined block by block."""
    blocks = F.ceil(F.col("members") / BLOCK)
    own, every = F.pmod(F.xxhash64("source_id"), blocks), F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    left = members.select("rule", "bucket", "source_id", own.alias("i"), every.alias("j"))
    right = members.select("rule", "bucket", F.col("source_id").alias("target_id"), every.alias("i"), own.alias("j"))
    return left.join(right, ["rule", "bucket", "i", "j"]).where(F.col("source_id") < F.col("target_id")).select("rule", "source_id", "target_id")


def output_input_pairs(docs: DataFrame) -> DataFrame:
    """(source_id, target_id), as often as both share a bucket: documents that put out what another takes in."""
    return _joined_sides(output_to_input(docs)).where(F.col("source_id") != F.col("target_id"))


def _joined_sides(rows: DataFrame) -> DataFrame:
    """(source_id, target_id) of outputs and inputs of a bucket; its sides are joined block by block."""
    blocks = {side: F.ceil(F.col(f"{side}s") / BLOCK) for side in ("output", "input")}
    own = {side: F.pmod(F.xxhash64("source_id"), blocks[side]) for side in blocks}
    every = {side: F.explode(F.sequence(F.lit(0).cast("bigint"), blocks[side] - 1)) for side in blocks}
    left = rows.where("side = 'output'").select("bucket", "source_id", own["output"].alias("i"), every["input"].alias("j"))
    right = rows.where("side = 'input'").select("bucket", F.col("source_id").alias("target_id"), every["output"].alias("i"), own["input"].alias("j"))
    return left.join(right, ["bucket", "i", "j"]).select("source_id", "target_id")


def _roles(docs: DataFrame) -> DataFrame:
    """(bucket, source_id, give, take): documents by their business objects; ``give`` has a bit for each role of ROLE_PAIRS that theirs contains, ``take`` those that complete one of them."""
    role = F.coalesce(blank_to_null("document_role"), blank_to_null("page_type_candidate"))
    rows = docs.select("source_id", role.alias("role"), F.explode("business_objects").alias("x")).where(F.col("role").isNotNull())
    rows = rows.select(folded(F.col("x")).alias("bucket"), "source_id", "role").where(F.length("bucket") >= 2).distinct()
    names = sorted({r for pair in ROLE_PAIRS for r in pair})
    others = {r: sum({1 << names.index(b) for pair in ROLE_PAIRS for a, b in (pair, pair[::-1]) if a == r}) for r in names}

    def bits(value: dict[str, int]) -> Column:
        return reduce(Column.bitwiseOR, [F.when(F.contains(F.col("role"), F.lit(r)), v).otherwise(0) for r, v in value.items()])

    return rows.select("bucket", "source_id", bits({r: 1 << i for i, r in enumerate(names)}).alias("give"), bits(others).alias("take")).where("give <> 0")


def complementary_pairs(docs: DataFrame) -> DataFrame:
    """(source_id, target_id), the smaller id first: documents that share an object and whose roles complete each other."""
    # roles are few: all documents of an object meet by pairs of roles that fit
    rows = cut(_roles(docs), "roles")
    size = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    rows = rows.join(size, "bucket").withColumn("rule", F.lit("complementary roles"))
    kinds = rows.select("source_id", "give", "take").distinct()
    pairs = every_pair(rows).distinct()
    pairs = pairs.join(kinds.select("source_id", "give"), "source_id").join(kinds.select(F.col("source_id").alias("target_id"), "take"), "target_id")
    return pairs.where(F.col("give").bitwiseAND(F.col("take")) != 0).select("source_id", "target_id")


def near_pairs(docs: DataFrame) -> DataFrame:
    """(source_id, target_id, cosine), the smaller id first: documents of which one is among the nearest of the other."""
    near = nearest_documents(docs)
    return near.groupBy(F.least("source_id", "target_id").alias("a"), F.greatest("source_id", "target_id").alias("b")).agg(F.max("cosine").alias("cosine")).select(F.col("a").alias("source_id"), F.col("b").alias("target_id"), "cosine")


def whole_evidence(docs: DataFrame) -> DataFrame:
    """(source_id, target_id, rule, cosine): what all ten rules say, of every pair of every bucket; cosine for near words only.

    ``whole_blocks`` merges the same without a row per rule and pair.
    """
    docs = cut(docs, "docs")  # the ten rules would each plan and read the listing again
    more = output_input_pairs(docs).select("source_id", "target_id", F.lit("output to input").alias("rule"))
    more = more.unionByName(complementary_pairs(docs).withColumn("rule", F.lit("complementary roles")))
    # plans of their own: one for all rules is more than the driver holds
    near = cut(near_pairs(docs), "near").withColumn("rule", F.lit("near words"))
    few = cut(_links(docs).unionByName(every_pair(_members(docs)).distinct()), "rules")
    return few.unionByName(more).withColumn("cosine", F.lit(None).cast("double")).unionByName(near)


def _bit(rule: str) -> int:
    return 1 << sorted(WHOLE_STRENGTH).index(rule)


def whole_blocks(docs: DataFrame) -> Blocks:
    """What ``whole_evidence`` says, in blocks of documents that make no rows of pairs: all buckets whole, whatever their sizes are."""
    docs = cut(docs, "docs")
    bit = F.create_map(*[F.lit(x) for k in WHOLE_STRENGTH for x in (k, _bit(k))])[F.col("rule")]
    # plans of their own: one for all rules is more than the driver holds
    near = cut(near_pairs(docs), "near").withColumn("rule", F.lit("near words"))
    links = cut(_links(docs), "few").withColumn("cosine", F.lit(None).cast("double")).unionByName(near)
    same = _members(docs).select("rule", "bucket", "source_id", F.lit(1).alias("give"), F.lit(1).alias("take"))
    sides = {"give": "output", "take": "input"}
    outputs = output_to_input(docs).groupBy("bucket", "source_id").agg(*[F.max((F.col("side") == s).cast("int")).alias(k) for k, s in sides.items()])
    rules = same.unionByName(outputs.withColumn("rule", F.lit("output to input"))).unionByName(_roles(docs).withColumn("rule", F.lit("complementary roles")))
    return in_blocks(docs, rules.withColumn("bit", bit).drop("rule"), links.withColumn("bit", bit).drop("rule"), _bit("output to input"))


def whole_edges(docs: DataFrame) -> DataFrame:
    """``scored_edges`` of ``whole_evidence``."""
    return _scored(whole_blocks(docs).edges())


def scored_edges(found: DataFrame) -> DataFrame:
    """(source_id, target_id, rules, strong, medium, weak, score) of every pair with any evidence; a rule counts once, however often it is given.

    Rules are bits of one number, so that a pair is a row of a fixed size in the one shuffle.
    """
    names = sorted(WHOLE_STRENGTH)
    bit = F.create_map(*[F.lit(x) for i, k in enumerate(names) for x in (k, 1 << i)])[F.col("rule")]
    cosine = F.max("cosine") if "cosine" in found.columns else F.lit(None).cast("double")
    return _scored(found.withColumn("bit", bit).groupBy("source_id", "target_id").agg(F.bit_or("bit").alias("bits"), cosine.alias("cosine")))


def _scored(rows: DataFrame) -> DataFrame:
    """``scored_edges`` of pairs, each one row with the bits of its rules."""
    names = sorted(WHOLE_STRENGTH)

    def has(k: str) -> Column:
        return F.col("bits").bitwiseAND(1 << names.index(k)) != 0

    n = {s: F.bit_count(F.col("bits").bitwiseAND(sum(1 << i for i, k in enumerate(names) if WHOLE_STRENGTH[k][0] == s))).cast("bigint") for s in ("strong", "medium", "weak")}
    best = F.greatest("cosine", *[F.when(has(k), F.lit(w)) for k, (_, w) in WHOLE_STRENGTH.items()])
    return rows.select(
        *[c for c in rows.columns if c not in ("bits", "cosine")],
        F.concat_ws("/", *[F.when(has(k), F.lit(k)) for k in names]).alias("rules"),
        *[v.alias(k) for k, v in n.items()],
        # to four places, halves up whatever their binary form
        (F.floor((n["strong"] * 100 + n["medium"] * 20 + n["weak"] * 2 + best) * 10000 + 0.500001) / 10000).alias("score"),
    )


def degrees(edges: DataFrame) -> DataFrame:
    """(source_id, degree): links of each document at either end."""
    return edges.select(F.explode(F.array("source_id", "target_id")).alias("source_id")).groupBy("source_id").agg(F.count(F.lit(1)).alias("degree"))


def whole_degrees(docs: DataFrame) -> DataFrame:
    """(source_id, degree): ``degrees`` of the edges of ``whole_evidence``, counted where two blocks of documents meet, so that no pair is written or shuffled."""
    return whole_blocks(docs).degrees()


def _by_strength(edges: DataFrame) -> DataFrame:
    """Strong evidence before any number of medium ones; scores stay under 1000."""
    return edges.withColumn("score", F.col("strong") * 1000 + F.col("score"))


def _plain_score(kept: DataFrame) -> DataFrame:
    return kept.withColumn("score", F.round(F.pmod("score", F.lit(1000.0)), 4))


def capped_by_strength(edges: DataFrame, most: int = 30) -> DataFrame:
    """``capped`` with strong evidence before any number of medium ones."""
    return _plain_score(capped(_by_strength(edges), most))


def whole_capped(docs: DataFrame, most: int = 30) -> DataFrame:
    """``capped_by_strength`` of the edges of ``whole_evidence``, by the numbers of documents from the merge on."""
    found = whole_blocks(docs)
    open_ = cut(_by_strength(_scored(found.numbers())).select("a", "b", "score"), "open")
    kept = _chosen(open_, found.ids.count(), most)
    drop_cut(open_)
    return _plain_score(_named(kept, found.ids))


def capped(edges: DataFrame, most: int = 30) -> DataFrame:
    """The edges a greedy choice keeps that goes through them from the best to the last and lets no document have more than ``most``.

    Documents are numbered in their order and edges sorted in ranges; one task goes through
    the ranges, written to the shared folder, in order. It holds a number per document and
    one batch of edges, and drops those at full documents by whole batches, so that it goes
    one by one through little more than what is kept.
    """
    open_ = cut(edges.select("source_id", "target_id", "score"), "open")
    ids = cut(numbered(open_.select(F.explode(F.array("source_id", "target_id")).alias("id")).distinct(), "id").select(F.col("id").alias("source_id"), F.col("n").cast("int").alias("n")), "ids")
    ends = _ends(ids)
    kept = _chosen(open_.join(ends["a"], "source_id").join(ends["b"], "target_id").select("a", "b", "score"), ids.count() + 1, most)
    drop_cut(open_)
    return _named(kept, ids)


def _ends(ids: DataFrame) -> dict[str, DataFrame]:
    return {end: ids.select(F.col("source_id").alias(f"{name}_id"), F.col("n").alias(end)) for end, name in (("a", "source"), ("b", "target"))}


def _named(kept: DataFrame, ids: DataFrame) -> DataFrame:
    """Numbers ``a`` and ``b`` as the ids that ``ids`` (source_id, n) has for them."""
    ends = _ends(ids)
    return kept.join(ends["a"], "a").join(ends["b"], "b").select("source_id", "target_id", "score")


def _chosen(edges: DataFrame, n: int, most: int) -> DataFrame:
    """What ``capped`` keeps of edges (a, b, score) of documents whose numbers are under ``n``."""
    spark = edges.sparkSession
    ranges = cut(edges.orderBy(-F.col("score"), "a", "b"), "sorted")
    files = files_in_order(ranges)

    def choose(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = array("i", [most]) * n
        for rows in batches_of_files(files):
            a, b = (rows.column(c).to_numpy() for c in ("a", "b"))
            yield rows.take(pa.array(_greedy(free, a, b), pa.int64()))

    kept = cut(spark.range(1, numPartitions=1).mapInArrow(choose, "a int, b int, score double"), "kept")
    drop_cut(ranges)
    return kept


def _greedy(free: array, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of the edges that are kept, in order, while both ends have a free place; ``free`` goes down."""
    now = np.frombuffer(free, dtype=np.int32)
    at = ((now[a] > 0) & (now[b] > 0)).nonzero()[0]
    keep = []
    for i, s, t in zip(at.tolist(), a[at].tolist(), b[at].tolist()):
        # an edge of a document with itself takes two places
        if free[s] > (s == t) and free[t] > 0:
            free[s] -= 1
            free[t] -= 1
            keep.append(i)
    return keep
