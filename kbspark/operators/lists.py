"""What belongs together and what is missing: set checks and lists over documents, folders and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbspark.functions.text import blank_to_null, canonical_hash, canonical_id, canonical_word
from kbspark.operators.documents import parent_folder
from kbspark.plans.skew import lookup


def current_relations(verdicts: DataFrame) -> DataFrame:
    """(relation_id, source_id, target_id, status, type, level, verified_at): of each relation the row verified last; ties go to the greatest."""
    fields = {"source_id": canonical_id("source_id"), "target_id": canonical_id("target_id"), "status": canonical_word("verification_status"), "type": blank_to_null("verified_relation_type"), "level": blank_to_null("review_level")}
    rows = verdicts.select(blank_to_null("relation_id").alias("relation_id"), F.struct("verified_at", *[c.alias(k) for k, c in fields.items()]).alias("r")).where("relation_id is not null")
    return rows.groupBy("relation_id").agg(F.max("r").alias("r")).select("relation_id", *[f"r.{k}" for k in fields], "r.verified_at")


def related_documents(relations: DataFrame) -> DataFrame:
    """(source_id, related_id, relation_id, type, side): every confirmed relation from the view of either end.

    One row per end: a record with a tenth of all relations is many rows, never one list.
    """
    good = relations.where((F.col("status") == "confirmed") & F.col("source_id").isNotNull() & F.col("target_id").isNotNull() & (F.col("source_id") != F.col("target_id")))
    views = F.array(
        F.struct(F.col("source_id").alias("id"), F.col("target_id").alias("related_id"), F.lit("source").alias("side")),
        F.struct(F.col("target_id").alias("id"), F.col("source_id").alias("related_id"), F.lit("target").alias("side")),
    )
    return good.select("relation_id", "type", F.explode(views).alias("v")).select(F.col("v.id").alias("source_id"), "v.related_id", "relation_id", "type", "v.side")


def relations_by_type(relations: DataFrame) -> DataFrame:
    """(source_id, type, relations, related): of each record how many relations and related records by type."""
    return related_documents(relations).groupBy("source_id", "type").agg(F.count_distinct("relation_id").alias("relations"), F.count_distinct("related_id").alias("related"))


def review_levels(relations: DataFrame) -> DataFrame:
    """(level, relations, confirmed, rejected, pending)."""
    s = F.coalesce("status", F.lit(""))
    return relations.groupBy("level").agg(F.count(F.lit(1)).alias("relations"), F.count_if(s == "confirmed").alias("confirmed"), F.count_if(s == "rejected").alias("rejected"), F.count_if(~s.isin("confirmed", "rejected")).alias("pending"))


def relation_creators(relations: DataFrame, docs: DataFrame, names: DataFrame) -> DataFrame:
    """(relation_id, source_creator, target_creator): the names of the creators of both ends, where known.

    ``docs`` has source_id and creator_uid, ``names`` creator_uid and creator_name. Records
    and creators with very many rows are joined apart.
    """
    named = lookup(docs.select("source_id", blank_to_null("creator_uid").alias("creator_uid")), names.select("creator_uid", "creator_name"), "creator_uid").select("source_id", "creator_name")
    rows = relations.select("relation_id", "source_id", "target_id")
    rows = lookup(rows, named.select("source_id", F.col("creator_name").alias("source_creator")), "source_id")
    rows = lookup(rows, named.select(F.col("source_id").alias("target_id"), F.col("creator_name").alias("target_creator")), "target_id")
    unknown = F.lit("未登记")
    return rows.select("relation_id", F.coalesce("source_creator", unknown).alias("source_creator"), F.coalesce("target_creator", unknown).alias("target_creator"))


def content_profiles(docs: DataFrame, semantic: DataFrame) -> DataFrame:
    """(source_id, content_hash, profile_id, page_type, rows): for every listed record the profile of the content it has.

    By the hash of the text, else of the file; the smallest id stands for the rows with one
    content, which many records may share.
    """
    profiles = semantic.select(canonical_hash("document_key").alias("content_hash"), canonical_id("source_id").alias("id"), blank_to_null("page_type_candidate").alias("page_type")).where("content_hash is not null and id is not null")
    profiles = profiles.groupBy("content_hash").agg(F.min(F.struct("id", "page_type")).alias("p"), F.count(F.lit(1)).alias("rows"))
    keyed = docs.select("source_id", F.coalesce("extracted_hash", "source_hash").alias("content_hash"))
    return lookup(keyed, profiles, "content_hash", "inner").select("source_id", "content_hash", F.col("p.id").alias("profile_id"), F.col("p.page_type").alias("page_type"), "rows")


def first_per_content(docs: DataFrame) -> DataFrame:
    """(content_hash, source_id, source_path, copies): the first record by path of each content."""
    rows = docs.select(F.coalesce("extracted_hash", "source_hash").alias("content_hash"), F.struct("source_path", "source_id").alias("r")).where("content_hash is not null")
    return rows.groupBy("content_hash").agg(F.min("r").alias("r"), F.count(F.lit(1)).alias("copies")).select("content_hash", "r.source_id", "r.source_path", "copies")


def folder_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(folder, source_id, side): ``missing`` records that a folder should have and hasn't, ``extra`` ones that it has besides."""
    sides = [df.select(parent_folder(F.col("source_path")).alias("folder"), "source_id").where("folder is not null").distinct().withColumn(name, F.lit(True)) for df, name in ((expected, "due"), (actual, "there"))]
    both = sides[0].join(sides[1], ["folder", "source_id"], "full_outer")
    return both.where("due is null or there is null").select("folder", "source_id", F.when(F.col("there").isNull(), "missing").otherwise("extra").alias("side"))


def id_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(source_id, side): ids of one side only."""
    both = left.select("source_id").distinct().withColumn("l", F.lit(True)).join(right.select("source_id").distinct().withColumn("r", F.lit(True)), "source_id", "full_outer")
    return both.where("l is null or r is null").select("source_id", F.when(F.col("l").isNull(), "right").otherwise("left").alias("side"))


def with_absent(current: DataFrame, old: DataFrame) -> DataFrame:
    """(source_id, file_name, kept): the current records, and of the old ones those that are gone."""
    gone = old.join(current.select("source_id"), "source_id", "left_anti")
    return current.select("source_id", "file_name", F.lit(False).alias("kept")).unionByName(gone.select("source_id", "file_name", F.lit(True).alias("kept")))


def under(path: Column, prefixes: tuple[str, ...]) -> Column:
    """Whether a path is one of the folders or below it."""
    out = F.lit(False)
    for p in prefixes:
        out = out | (path == p) | F.startswith(path, F.lit(p + "/"))
    return out


def leads_to(path: Column, prefixes: tuple[str, ...]) -> Column:
    """Whether a folder is above one of the folders, so that a walk must go through it."""
    return F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.startswith(p, F.concat(path, F.lit("/")))) if prefixes else F.lit(False)


def selected_paths(docs: DataFrame, include: tuple[str, ...], exclude: tuple[str, ...]) -> DataFrame:
    """Records below the folders to include and not below those to exclude; all where none is to be included."""
    path = F.col("source_path")
    return docs.where((under(path, include) if include else F.lit(True)) & ~F.coalesce(under(path, exclude), F.lit(False)))


def page_types(docs: DataFrame) -> DataFrame:
    """(page_type, documents, folders, with_content)."""
    return docs.groupBy(blank_to_null("page_type_candidate").alias("page_type")).agg(F.count(F.lit(1)).alias("documents"), F.count_distinct(parent_folder(F.col("source_path"))).alias("folders"), F.count_if(blank_to_null("content").isNotNull()).alias("with_content"))


def metadata_times(docs: DataFrame, relations: DataFrame) -> DataFrame:
    """(source_id, updated, verified, latest) in microseconds: when a record, or a confirmed relation at either end, changed last."""
    ends = relations.where("status = 'confirmed'").select(F.explode(F.array_distinct(F.array("source_id", "target_id"))).alias("source_id"), F.unix_micros(F.col("verified_at").cast("timestamp")).alias("v"))
    seen = ends.where("source_id is not null").groupBy("source_id").agg(F.max("v").alias("verified"))
    return docs.select("source_id", "updated").join(seen, "source_id", "left").select("source_id", "updated", "verified", F.greatest("updated", "verified").alias("latest"))


def conflict_signatures(relations: DataFrame, hashes: DataFrame, known: DataFrame) -> DataFrame:
    """(relation_id, signature, is_new) of the relations flagged as conflicts: both ends with the contents they have, and whether those were seen so before.

    ``relations`` has relation_id, source_id and target_id of the flagged ones; ``hashes`` and
    ``known`` have source_id and content_hash, now and then. A conflict is known if both ends
    had the same contents then.
    """
    rows = relations
    for end in ("source", "target"):
        for when, table in (("now", hashes), ("then", known)):
            rows = rows.join(table.select(F.col("source_id").alias(f"{end}_id"), F.coalesce("content_hash", F.lit("")).alias(f"{end}_{when}")), f"{end}_id", "left")
    same = F.lit(True)
    for end in ("source", "target"):
        same = same & F.col(f"{end}_now").eqNullSafe(F.col(f"{end}_then")) & F.col(f"{end}_then").isNotNull()
    text = F.concat_ws("|", "source_id", F.coalesce("source_now", F.lit("")), "target_id", F.coalesce("target_now", F.lit("")))
    return rows.select("relation_id", F.sha2(text, 256).alias("signature"), (~same).alias("is_new"))


def unseen_contents(now: DataFrame, before: DataFrame) -> DataFrame:
    """(content_hash, records): contents of the listing that no earlier one had, which nothing is known of yet."""
    key = F.coalesce("extracted_hash", "source_hash").alias("content_hash")
    rows = now.select(key).where("content_hash is not null").groupBy("content_hash").agg(F.count(F.lit(1)).alias("records"))
    return rows.join(before.select(key), "content_hash", "left_anti")


def longest_names(docs: DataFrame) -> DataFrame:
    """(folder, file_name): the longest file name of each folder, of equal ones the first."""
    rows = docs.select(parent_folder(F.col("source_path")).alias("folder"), F.struct((-F.length("file_name")).alias("n"), "file_name").alias("r")).where("folder is not null and file_name is not null")
    return rows.groupBy("folder").agg(F.min("r").alias("r")).select("folder", "r.file_name")
