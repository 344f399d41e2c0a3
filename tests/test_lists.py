"""Orders, lists and messages against plain Python on small rows."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from kbspark.functions import markup, messages
from kbspark.functions.titles import business_ids
from kbspark.operators import incremental, lists, order, relations


def test_numbers_follow_the_order_over_all_partitions(spark):
    rnd = random.Random(1)
    values = [(rnd.randrange(40), i) for i in range(500)]
    rows = order.numbered(spark.createDataFrame(values, "a int, i int").repartition(7), "a", "i").collect()
    assert [(r.a, r.i) for r in sorted(rows, key=lambda r: r.n)] == sorted(values)
    assert sorted(r.n for r in rows) == list(range(1, 501))
    assert order.numbered(spark.createDataFrame([], "a int, i int"), "a", "i").count() == 0
    batches = order.batches_of(spark.createDataFrame(values, "a int, i int"), 30, "a", "i").groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in batches) == [(k, 30) for k in range(16)] + [(16, 20)]


@pytest.mark.parametrize(("n", "rate"), [(0, 0.2), (1, 0.2), (5, 0.2), (7, 0.5), (6, 1.0), (6, 0.0), (6, -1.0), (6, 7.0)])
def test_lowest_share(spark, n, rate):
    keys = [f"REL-{i}" for i in range(n)]
    got = {r.k for r in order.lowest_share(spark.createDataFrame([(k,) for k in keys], "k string"), "k", rate).collect()}
    most = max(1, math.ceil(n * min(rate, 1.0))) if rate > 0 else 0
    assert got == set(sorted(keys, key=lambda k: hashlib.sha256(k.encode()).hexdigest())[:most])


@pytest.mark.parametrize(("n", "picks"), [(10, 1), (10, 2), (10, 4), (11, 3), (3, 7), (0, 3), (5, 0)])
def test_evenly_spaced(spark, n, picks):
    got = sorted(r.i for r in order.spaced(spark.createDataFrame([(i,) for i in range(n)], "i int"), picks, "i").collect())
    at = list(range(n)) if picks == 0 else [] if n == 0 else [n // 2] if picks == 1 else sorted({round(i * (n - 1) / (picks - 1)) for i in range(picks)})
    assert got == at


def test_packs_fill_in_order(spark):
    rnd = random.Random(2)
    rows = [(f"l{rnd.randrange(5)}", i, rnd.choice([1, 7, 30, 99, 250, None])) for i in range(300)] + [(None, 300, 5)]
    got = order.packed(spark.createDataFrame(rows, "lane string, i int, size long"), "lane", "size", 4, 120, "i").collect()
    want = {}
    for lane in {r[0] for r in rows}:
        pack, items, total = 0, 0, 0
        for _, i, size in sorted((r for r in rows if r[0] == lane), key=lambda r: r[1]):
            if items and (items >= 4 or total + (size or 0) > 120):
                pack, items, total = pack + 1, 0, 0
            items, total = items + 1, total + (size or 0)
            want[i] = pack
    assert {r.i: r.pack for r in got} == want


def test_states_of_missing_and_restored_records(spark):
    scans = spark.createDataFrame([(f"s{k}", k) for k in range(1, 6)], "snapshot_id string, scan_no int")
    seen = {"always": {k: 1 for k in range(1, 6)}, "back": {1: 1, 4: 2, 5: 2}, "gone": {1: 1, 2: 1}, "late": {3: 1, 4: 5, 5: 5}}
    each = spark.createDataFrame([(i, f"s{k}", u) for i, own in seen.items() for k, u in own.items()], "source_id string, snapshot_id string, updated long")
    got = {(r.source_id, r.snapshot_id): (r.state, r.missing_scans) for r in incremental.change_states(each, scans).collect()}
    want = {("always", f"s{k}"): ("unchanged", 0) for k in range(2, 6)}
    want |= {("back", "s2"): ("suspected", 1), ("back", "s3"): ("orphan", 2), ("back", "s4"): ("restored", 2), ("back", "s5"): ("unchanged", 0)}
    want |= {("gone", "s2"): ("unchanged", 0), ("gone", "s3"): ("suspected", 1), ("gone", "s4"): ("orphan", 2), ("gone", "s5"): ("orphan", 3)}
    want |= {("late", "s3"): ("new", 0), ("late", "s4"): ("content_check", 0), ("late", "s5"): ("unchanged", 0)}
    assert got == want
    checked = incremental.change_states(each, scans, confirm=0, audit=True).collect()
    assert {r.state for r in checked} == {"content_check", "restored", "new", "orphan"}


def test_working_set_keeps_what_is_blank_and_voids_what_changed(spark):
    scans = spark.createDataFrame([("s1", 1), ("s2", 2)], "snapshot_id string, scan_no int")
    rows = [
        ("same", "s1", "a", "u1", "p1", "h", "x", 1), ("same", "s2", "a2", " ", None, "h2", "x2", 1),
        ("changed", "s1", "b", "u1", "p1", "h", "x", 1), ("changed", "s2", "b", "u2", "p1", "h", "x", 2),
        ("new", "s2", "c", None, None, "h", "x", 1), ("gone", "s1", "d", "u4", "p4", "h", "x", 1),
    ]
    each = spark.createDataFrame(rows, "source_id string, snapshot_id string, file_name string, creator_uid string, permission_hash string, source_hash string, extracted_hash string, updated long")
    got = {r[0]: tuple(r[1:]) for r in incremental.working_set(each, scans).collect()}
    assert got == {
        "same": ("listed", "a2", "u1", "p1", "h2", "x2", False),
        "changed": ("listed", "b", "u2", "p1", None, None, True),
        "new": ("listed", "c", None, None, None, None, True),
        "gone": ("missing", "d", "u4", "p4", "h", "x", False),
    }


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


def test_links_and_messages(spark):
    signed = "见https://a.example/x?Expires=1&Signature=z#f。 另见（https://b.example/y?q=1）， <http://c.example?token=1>)."
    assert one(spark, messages.plain_urls, signed) == "见https://a.example/x。 另见（https://b.example/y?q=1）， <http://c.example>)."
    assert one(spark, messages.plain_urls, "https://a.example/x?token=1") == "https://a.example/x"
    assert one(spark, messages.plain_urls, "no link") == "no link" and one(spark, messages.plain_urls, "") == "" and one(spark, messages.plain_urls, None) is None
    assert one(spark, messages.safe_message, "GET https://a.example/x failed, API_KEY: abc123 left") == "GET [URL] failed, API_KEY=[REDACTED] left"
    assert len(one(spark, messages.safe_message, "x" * 5000)) == 1000
    assert one(spark, messages.safe_name, " a/b:c\x07.. ") == "a_b_c_" and one(spark, messages.safe_name, "..") == "未命名"
    assert one(spark, messages.inline_text, " a \n b|c ") == "a b｜c" and one(spark, messages.inline_text, None) == ""


@pytest.mark.parametrize(("text", "want"), [('["a", 1, null]', ["a", "1", None]), ("[]", []), ('{"a": 1}', []), ("冲突", ["冲突"]), ("", []), (None, []), ('["冲突"]', ["冲突"])])
def test_json_lists(spark, text, want):
    assert one(spark, messages.json_list, text) == want


def test_visible_characters_and_endings(spark):
    assert one(spark, messages.visible_characters, "Ｈello，\\ 世界 ① ﬁn ẞ") == "hello世界1finss"
    assert one(spark, messages.visible_characters, None) is None
    assert one(spark, messages.last_lines, "# Top\r\n- see [the page](http://x) 12\n\n> end") == ["end", "", "see the page 12", "Top"]


def test_fingerprints_see_names_and_values(spark):
    row = spark.createDataFrame([("x", None)], "a string, b string")
    f = lambda **k: row.select(messages.fingerprint(**k)).first()[0]
    assert f(a=F.col("a"), b=F.col("b")) == hashlib.sha256('{"a":"x","b":""}'.encode()).hexdigest() == f(b=F.col("b"), a=F.col("a"))
    assert f(a=F.col("a"), b=F.col("a")) != f(a=F.col("a"), b=F.col("b"))


def test_prefixes_are_folders(spark):
    docs = spark.createDataFrame([("1", "a/b/x"), ("2", "ab/x"), ("3", "a"), ("4", "a/c/x"), ("5", None)], "source_id string, source_path string")
    assert {r.source_id for r in lists.selected_paths(docs, ("a",), ("a/c",)).collect()} == {"1", "3"}
    assert {r.source_id for r in lists.selected_paths(docs, (), ("a/c",)).collect()} == {"1", "2", "3", "5"}
    assert {r.source_id for r in docs.where(lists.leads_to(F.col("source_path"), ("a/b/c",))).collect()} == {"3"}


def test_relations_from_either_end(spark):
    rows = [("r1", "confirmed", "A", "B"), ("r2", "rejected", "A", "C"), ("r3", "confirmed", "A", "A"), ("r4", "confirmed", None, "B")]
    df = spark.createDataFrame([(r, " kb " if s == "x" else s, a, b) for r, s, a, b in rows], "relation_id string, status string, source_id string, target_id string").withColumn("type", F.lit("t"))
    assert {tuple(r) for r in lists.related_documents(df).collect()} == {("A", "B", "r1", "t", "source"), ("B", "A", "r1", "t", "target")}


def test_third_kind_of_business_ids(spark):
    text = "PRJ-123a ticket_77 work-900 ABC-2024-7 AB/123 abc-123 A-123 XY-12"
    assert set(one(spark, business_ids, text)) == {"PRJ-123A", "WORK-900", "ABC-2024-7", "AB/123"}


def test_links_ids_and_numbers_in_texts(spark):
    """Rules that find nothing in the given tables, on rows of their own."""
    rows = [
        ("KB-00000000000A", "a.md", "n1", "see https://x.example/i/nodes/n2?q and https://x.example/nodes/none, PRJ 1234", None),
        ("KB-00000000000B", "b ABC-2024-7.md", "n2", "as kb-00000000000a says, KB-00000000000B too; prj-1234", None),
        ("KB-00000000000C", "c.md", None, "ABC-2024-7 and https://x.example/spaces/n1", None),
        ("KB-00000000000D", "d.md", " ", None, None),
    ]
    docs = spark.createDataFrame(rows, "source_id string, file_name string, node_id string, content string, bucket string")
    a, b, c = (f"KB-00000000000{x}" for x in "ABC")
    assert {tuple(r) for r in relations.linked_nodes(docs).collect()} == {(a, b), (c, a)}
    assert {(r.source_id, r.target_id) for r in relations.mentioned_ids(docs).collect()} == {(b, a)}
    got = {(r.bucket, r.source_id) for r in relations.same_business_id(docs).collect()}
    assert got == {("ABC-2024-7", b), ("ABC-2024-7", c)}


def test_buckets_over_their_bound_make_no_pairs(spark):
    members = [("same folder", "f", f"K{i:03}", 51) for i in range(51)]
    df = spark.createDataFrame(members, "rule string, bucket string, source_id string, members long")
    assert relations.pairs_within(df.where(F.col("members") <= relations.BOUNDS["same folder"]), 50).count() == 0
    assert relations.pairs_within(df).count() == 50


def test_titles_of_markdown(spark):
    title, rest = markup.title_and_rest(F.col("t"))
    rows = ["# A \nb # c", "x\r\n#  B\n# C", "## no", "", None, "#none\n# Yes"]
    got = [tuple(r) for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").orderBy("i").select(title, rest).collect()]
    assert got == [("A", "\nb # c"), ("B", "x\r\n\n# C"), (None, "## no"), (None, ""), (None, None), ("Yes", "#none\n")]


def test_conflicts_are_known_while_contents_stay(spark):
    r = spark.createDataFrame([("r1", "A", "B"), ("r2", "A", "C"), ("r3", "A", "D"), ("r4", None, "A")], "relation_id string, source_id string, target_id string")
    h = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "3"), ("D", "4")], "source_id string, content_hash string")
    k = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "9")], "source_id string, content_hash string")
    assert {x.relation_id: x.is_new for x in lists.conflict_signatures(r, h, k).collect()} == {"r1": False, "r2": True, "r3": True, "r4": True}
