import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kbspark.functions import titles as T
from kbspark.functions.text import canonical_extension, canonical_hash, canonical_id
from kbspark.operators import folders, merging, neighbours, relations
from kbspark.plans.skew import lookup


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("value", "want"), [(" kb-1a　\n", "KB-1A"), ("\t 　", None), (None, None), ("KB-2", "KB-2")])
def test_canonical_ids(spark, value, want):
    assert one(spark, value, canonical_id) == want


@pytest.mark.parametrize(("value", "want"), [("sha256:ABC ", "abc"), (" ", None), (None, None), ("abc", "abc")])
def test_canonical_hashes(spark, value, want):
    assert one(spark, value, canonical_hash) == want


@pytest.mark.parametrize(("value", "want"), [(".ADOC", "adoc"), (None, ""), (" pdf ", "pdf")])
def test_canonical_extensions(spark, value, want):
    assert one(spark, value, canonical_extension) == want


@pytest.mark.parametrize(("value", "want"), [("合同备注手册 v2.6.docx", "合同备注手册"), ("合同备注手册_最终版.md", "合同备注手册"), ("Plan-2025-05-27.adoc", "plan"), ("[KB-0123456789AB]Plan.v.md", "planv"), (".md", "md")])
def test_title_keys(spark, value, want):
    assert one(spark, value, T.title_key) == want


def test_words_split_han_runs_into_pairs(spark):
    assert one(spark, "知识库管理 abc-1 7 2024", T.words) == ["知识", "识库", "库管", "管理", "abc-1", "2024"]
    assert one(spark, "正文", T.words) == ["正文"]


@pytest.mark.parametrize(("value", "want"), [("https://d.example/n/1?Expires=1&Signature=x#f", "https://d.example/n/1"), ("https://d.example/n/1?page=2", "https://d.example/n/1?page=2"), (None, None)])
def test_signed_links(spark, value, want):
    assert one(spark, value, T.plain_url) == want


def test_secrets_are_replaced_and_named(spark):
    df = spark.createDataFrame([("password: hunter2abc, api_key=abcdef123456 ok",)], "x string")
    text, labels = T.without_secrets(F.col("x"))
    assert tuple(df.select(text.alias("t"), labels.alias("l")).first()) == ("password: [REDACTED], api_key=[REDACTED] ok", ["password", "token"])


def test_large_buckets_become_stars(spark):
    rows = spark.createDataFrame([("big", f"d{i:03}") for i in range(60)] + [("few", "a"), ("few", "b"), ("few", "b"), ("one", "z"), (None, "n")], "bucket string, source_id string")
    got = relations.pairs_within(relations.memberships(rows, "r"), limit=50).collect()
    assert {(r.source_id, r.target_id) for r in got if r.form == "pair"} == {("a", "b")}
    assert {(r.source_id, r.target_id) for r in got if r.form == "member"} == {("d000", f"d{i:03}") for i in range(1, 60)}


@pytest.mark.parametrize("seed", range(3))
def test_capped_edges_equal_the_sequential_choice(spark, seed):
    rnd = random.Random(seed)
    edges = list({(f"a{rnd.randrange(12):02}", f"b{rnd.randrange(12):02}"): rnd.choice([1.0, 2.0, 5.0]) for _ in range(90)}.items())
    df = spark.createDataFrame([(a, b, s) for (a, b), s in edges], "source_id string, target_id string, score double")
    used, want = {}, set()
    for (a, b), _ in sorted(edges, key=lambda e: (-e[1], e[0])):
        if used.get(a, 0) < 3 and used.get(b, 0) < 3:
            used[a], used[b] = used.get(a, 0) + 1, used.get(b, 0) + 1
            want.add((a, b))
    assert {(r.source_id, r.target_id) for r in relations.capped(df, 3).collect()} == want


def test_capped_edges_take_the_same_steps_however_long_a_chain_is(spark, monkeypatch):
    """Each edge waits for the one before it: a round for every other one once."""
    chain = [(f"a{i:02}", f"a{i + 1:02}", 100.0 - i) for i in range(24)] + [("b", "b", 1.0), ("c", "d", 1.0)]
    tags, cut = [], relations.cut
    monkeypatch.setattr(relations, "cut", lambda df, tag: tags.append(tag) or cut(df, tag))
    df = spark.createDataFrame(chain, "source_id string, target_id string, score double")
    want = {(f"a{i:02}", f"a{i + 1:02}", 100.0 - i) for i in range(0, 24, 2)} | {("c", "d", 1.0)}
    assert {tuple(r) for r in relations.capped(df, 1).collect()} == want
    assert len(tags) <= 4
    assert relations.capped(df.limit(0), 1).count() == 0


def test_a_rule_counts_once_for_a_pair(spark):
    rows = [("a", "b", "output to input", None)] * 2 + [("a", "b", "near words", 0.9), ("a", "c", "near words", 0.3)]
    got = {r.target_id: tuple(r)[2:] for r in relations.scored_edges(spark.createDataFrame(rows, "source_id string, target_id string, rule string, cosine double")).collect()}
    assert got == {"b": ("near words/output to input", 0, 1, 1, 22.9), "c": ("near words", 0, 0, 1, 2.3)}


def test_folder_index(spark):
    df = spark.createDataFrame([("1", "a/b/x"), ("2", "a/y"), ("3", "root")], "source_id string, source_path string")
    got = {r.folder: (r.depth, r.documents, r.folders, r.all_documents) for r in folders.folder_index(df).collect()}
    assert got == {"a": (1, 1, 1, 2), "a/b": (2, 1, 0, 1)}


def test_lookup_keeps_every_row_once(spark):
    facts = spark.range(5000).select((F.when(F.col("id") < 3000, 0).otherwise(F.col("id"))).alias("k"), "id")
    table = spark.range(0, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    import kbspark.plans.skew as skew

    plain = {tuple(r) for r in facts.join(table, "k", "left").select("k", "id", "v").collect()}
    old = skew.hot_keys.__defaults__
    skew.hot_keys.__defaults__ = (0.001, 100)
    try:
        got = lookup(facts, table, "k").select("k", "id", "v").collect()
    finally:
        skew.hot_keys.__defaults__ = old
    assert len(got) == 5000
    assert {tuple(r) for r in got} == plain


PROFILE = "source_id string, file_name string, summary string, core_theme string, keywords array<string>, business_objects array<string>"


def test_every_copy_has_its_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 2)
    rows = [(f"c{i:02}", "alpha beta", None, None, ["gamma"], None) for i in range(14)]
    rows += [("s1", "delta", "alpha epsilon", None, None, None), ("s2", "eta", "theta", None, None, ["iota"]), ("s3", "kappa", None, None, None, ["iota"]), ("none", None, None, None, None, None)]
    got = {}
    for r in neighbours.nearest_documents(spark.createDataFrame(rows, PROFILE)).orderBy("source_id", "rank").collect():
        got.setdefault(r.source_id, []).append((r.class_id, r.target_id, r.cosine))
    copies = [f"c{i:02}" for i in range(14)]
    for c in copies:
        assert got[c] == [("c00", o, 1.0) for o in copies if o != c][:10]
    # by the summary and the business objects alone
    assert [t for _, t, _ in got["s1"]] == copies[:10] and 0.12 <= got["s1"][0][2] < 0.5
    assert [t for _, t, _ in got["s2"]] == ["s3"] and [t for _, t, _ in got["s3"]] == ["s2"]
    assert "none" not in got


@pytest.mark.parametrize(("threshold", "vocabulary"), [(0.12, 40), (0.5, 40), (0.12, 2000)])
def test_blocks_find_the_nearest_both_ways(monkeypatch, threshold, vocabulary):
    for name, value in (("CHUNK", 7), ("POSTINGS", 9), ("PAIRS", 5)):
        monkeypatch.setattr(neighbours, name, value)
    rnd = np.random.default_rng(vocabulary)
    tables = []
    for n in (60, 45):
        x = np.zeros((n, vocabulary))
        for r in x:
            # few words are in most rows, most are rare; rows of one word give equal cosines
            r[np.unique((vocabulary * rnd.random(rnd.integers(1, 12)) ** 3).astype(int))] = 1
        tables.append(x / np.sqrt((x * x).sum(axis=1))[:, None])
    rows = [neighbours._Rows(np.concatenate([[0], np.cumsum((x > 0).sum(axis=1))]), x.nonzero()[1], x[x > 0]) for x in tables]
    for left, right, a, b, same in ((*rows, *tables, False), (rows[0], rows[0], tables[0], tables[0], True)):
        got: dict = {}
        for turned, s, t, c in neighbours.best_of_blocks(left, right, same, vocabulary, threshold, 4):
            for k in range(len(s)):
                got.setdefault((turned, int(s[k])), []).append((int(t[k]), float(c[k])))
        for turned in (False, True)[: 2 - same]:
            scores = np.round((a @ b.T).T if turned else a @ b.T, 6)
            for s in range(len(scores)):
                want = sorted((-c, t) for t, c in enumerate(scores[s].tolist()) if c >= threshold and not (same and s == t))[:4]
                assert [(t, c) for t, c in got.get((turned, s), [])] == [(t, -c) for c, t in want]


def test_cosine_neighbours_shuffle_no_pairs(spark):
    rows = [(f"d{i:03}", "alpha beta", None, f"word{i} gamma", None, None) for i in range(40)]
    found = neighbours.cosine_neighbours(spark.createDataFrame(rows, PROFILE), 0.1)
    assert "SortMergeJoin" not in (plan := found._jdf.queryExecution().toString()) and "Join" not in plan.split("== Physical Plan ==")[1]
    got: dict = {}
    for r in found.orderBy("source_id", "rank").collect():
        got.setdefault(r.source_id, []).append(r.target_id)
    # all cosines are equal: the smallest ids count
    ids = [f"d{i:03}" for i in range(40)]
    assert got == {i: [j for j in ids if j != i][:10] for i in ids}


def test_whole_evidence_has_all_rules(spark, monkeypatch):
    monkeypatch.setattr(relations, "BLOCK", 2)
    schema = PROFILE + ", content string, node_id string, source_path string, document_role string, page_type_candidate string, inputs array<string>, outputs array<string>, version_signals array<string>, explicit_references array<struct<target_text: string>>"
    # cited title and output to input; one object and completing roles; the same words
    rows = [("A", "plan one", None, None, None, None, "见《budget two》", None, "x/a", None, None, None, ["Out Put"], None, None), ("B", "budget two", None, None, None, None, None, None, "y/b", None, None, ["output"], None, None, None)]
    rows += [(f"C{i}", f"name{i}aa", None, None, None, ["object"], None, None, f"c{i}/c", "制度" if i else "流程模板", None, None, None, None, None) for i in range(3)]
    rows += [(f"D{i}", f"doc{i}bb", None, None, None, None, None, None, f"d{i}/d", None, None, ["many"] if i % 2 else None, None if i % 2 else ["many"], None, None) for i in range(10)]
    got = {(r.source_id, r.target_id): r for r in relations.scored_edges(relations.whole_evidence(spark.createDataFrame(rows, schema))).collect()}
    assert (got["A", "B"].rules, got["A", "B"].medium, got["A", "B"].score) == ("cited title/output to input", 2, 40.74)
    assert got["C0", "C1"].rules == "complementary roles/near words" and got["C1", "C2"].rules == "near words"
    assert 22.66 == got["C0", "C1"].score and got["C1", "C2"].score > 2.12
    assert {k for k in got if k[0][0] == "D"} == {(f"D{i}", f"D{j}") for i in range(0, 10, 2) for j in range(1, 10, 2)}


def test_near_words_have_a_plan_of_their_own(spark):
    schema = PROFILE + ", content string, node_id string, source_path string, document_role string, page_type_candidate string, inputs array<string>, outputs array<string>, version_signals array<string>, explicit_references array<struct<target_text: string>>"
    rows = [(f"E{i}", "alpha beta", None, None, None, None, None, None, f"e{i}/e", None, None, None, None, None, None) for i in range(3)]
    found = relations.whole_evidence(spark.createDataFrame(rows, schema))
    assert "FlatMapGroupsInArrow" not in found._jdf.queryExecution().toString()
    assert sum(r.rule == "near words" for r in found.collect()) == 3


def test_whole_degrees_make_no_pairs_of_outputs_and_inputs(spark, monkeypatch):
    """As many as the edges have, with documents in both sides of a bucket, of several buckets, and pairs that other rules make too."""
    monkeypatch.setattr(relations, "BLOCK", 2)
    schema = PROFILE + ", content string, node_id string, source_path string, document_role string, page_type_candidate string, inputs array<string>, outputs array<string>, version_signals array<string>, explicit_references array<struct<target_text: string>>"
    sets = [None, ["A a"], ["bb"], ["aa", "b b"], ["cc", None, "x"], ["AA", "cc"]]
    # a folder makes pairs of the smaller id first, a title cited those of the other way too
    rows = [(f"D{i:02}", f"file{i:02}", None, None, [f"word{i % 11}"], None, f"见《file{(i * 7) % 40:02}》", None, f"f{i % 9}/x", None, None, sets[i % 6], sets[(i // 6) % 6], None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, schema)
    want = {tuple(r) for r in relations.degrees(relations.scored_edges(relations.whole_evidence(docs))).collect()}

    def fail(docs):
        raise AssertionError("pairs of outputs and inputs")

    monkeypatch.setattr(relations, "output_input_pairs", fail)
    got = relations.whole_degrees(docs)
    assert got.dtypes == [("source_id", "string"), ("degree", "bigint")]
    assert len(want) == 40 and sorted(tuple(r) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("blocks", range(1, 10))
@pytest.mark.parametrize("tasks", [1, 5, 100])
def test_every_pair_of_blocks_is_compared_once(monkeypatch, blocks, tasks):
    monkeypatch.setattr(neighbours, "TASKS", tasks)
    pairs = [tuple(sorted((i, j))) for i, others in neighbours.pairs_of_blocks(blocks) for j in others]
    assert sorted(pairs) == [(i, j) for i in range(blocks) for j in range(i, blocks)]


def test_kinds_change_nothing_but_the_blocks(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(f"d{i:03}", " ".join(rnd.choices([f"{'ab' if i % 3 else 'cd'}{k}" for k in range(30)], k=8)), None, None, ["both"] if i % 5 == 0 else None, None) for i in range(150)]
    docs = spark.createDataFrame(rows, PROFILE)
    want = sorted(tuple(r) for r in neighbours.nearest_documents(docs).collect())
    for name, value in (("BLOCK", 16), ("SAMPLE", 50), ("TASKS", 4), ("CHUNK", 5), ("HEADS", 32)):
        monkeypatch.setattr(neighbours, name, value)
    made = []
    write = neighbours.write_blocks
    monkeypatch.setattr(neighbours, "write_blocks", lambda *a: made.append(write(*a)) or made[-1])
    assert sorted(tuple(r) for r in neighbours.nearest_documents(docs).collect()) == want
    assert made[0][1] >= 10 and len(want) > 1000


WHOLE = PROFILE + ", content string, node_id string, source_path string, document_role string, page_type_candidate string, inputs array<string>, outputs array<string>, version_signals array<string>, explicit_references array<struct<target_text: string>>"


def crowd(spark):
    """60 documents of one content, of one title, of one id, in one folder and of one object, each more than a bound had."""
    rows = [(f"A{i:02}", f"aa{i:02}", None, None, None, None, "the same", None, f"a{i}/x", None, None, None, None, None, None) for i in range(60)]
    rows += [(f"B{i:02}", f"plan title v{i}.md", None, None, None, None, None, None, f"b{i}/x", None, None, None, None, None, None) for i in range(60)]
    rows += [(f"C{i:02}", f"cc{i:02}", None, None, None, None, f"ABC-2024-7 {i}", None, f"c{i}/x", None, None, None, None, None, None) for i in range(60)]
    rows += [(f"D{i:02}", f"dd{i:02}", None, None, None, None, None, None, "d/d/x", None, None, None, None, None, None) for i in range(60)]
    rows += [(f"E{i:02}", f"ee{i:02}", None, None, None, ["object"], None, None, f"e{i}/x", None if i % 3 else "制度", "模板" if i % 3 == 1 else None, None, None, None, None) for i in range(60)]
    return spark.createDataFrame(rows, WHOLE)


def test_large_buckets_are_whole_in_the_edges(spark):
    """A bound of 30, 40 or 50 documents, or links to the smallest member, had dropped pairs of all five."""
    got: dict = {}
    for r in relations.whole_edges(crowd(spark)).collect():
        assert r.source_id < r.target_id and r.source_id[0] == r.target_id[0]
        for rule in r.rules.split("/"):
            got.setdefault((rule, r.source_id[0]), set()).add((r.source_id, r.target_id))
    every = {x: {(f"{x}{i:02}", f"{x}{j:02}") for i in range(60) for j in range(i + 1, 60)} for x in "ABCDE"}
    for rule, x in (("same content", "A"), ("same title", "B"), ("same business id", "C"), ("same folder", "D")):
        assert got[rule, x] == every[x]
    assert got["complementary roles", "E"] == {(a, b) for a, b in every["E"] if {int(a[1:]) % 3, int(b[1:]) % 3} == {0, 1}}


@pytest.mark.parametrize("side", [7, 2048])
def test_blocks_merge_what_the_rules_say(spark, monkeypatch, side):
    """As the rules' own rows, with both directions, several buckets of a pair, and copies; however documents fall into blocks."""
    rnd = random.Random(side)
    monkeypatch.setattr(merging, "SIDE", side)
    monkeypatch.setattr(merging, "PAIRS", 5)
    monkeypatch.setattr(relations, "BLOCK", 3)
    some = [None, [], ["A a"], ["bb"], ["aa", "b b"], ["cc", None, "x"], ["AA", "cc"]]
    roles = [None, " ", "制度", "执行流程", "模板", "案例与流程"]
    rows = [(f"D{rnd.randrange(10)}{i:02}", f"file{i % 9} v{i}" if i % 2 else f"file{i:02}", None, None, [f"word{i % 11}"], rnd.choice(some), rnd.choice([f"见《file{(i * 7) % 40:02}》 PRJ-1234", "copy", "copy", None]), None, f"f{i % 3}/x", rnd.choice(roles), rnd.choice(roles), rnd.choice(some), rnd.choice(some), None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, WHOLE)
    want = sorted(tuple(r) for r in relations.scored_edges(relations.whole_evidence(docs)).collect())
    assert {rule for r in want for rule in r[2].split("/")} == set(relations.WHOLE_STRENGTH) - {"linked node", "mentioned id"}
    edges = relations.whole_edges(docs)
    assert sorted(tuple(r) for r in edges.collect()) == want
    assert "SortMergeJoin" not in (plan := edges._jdf.queryExecution().toString()) and "Exchange" not in plan
    assert sorted(tuple(r) for r in relations.whole_degrees(docs).collect()) == sorted(tuple(r) for r in relations.degrees(edges).collect())


def test_large_buckets_count_in_the_degrees(spark):
    got = {r.source_id: r.degree for r in relations.whole_degrees(crowd(spark)).collect()}
    assert {got[f"{x}{i:02}"] for x in "ABCD" for i in range(60)} == {59}


def test_large_buckets_are_in_the_choice(spark):
    """The sequential choice among all pairs, those of large buckets too."""
    docs = crowd(spark)
    used, want = {}, set()
    for r in sorted(relations.whole_edges(docs).collect(), key=lambda r: (-r.strong * 1000 - r.score, r.source_id, r.target_id)):
        if used.get(r.source_id, 0) < 30 and used.get(r.target_id, 0) < 30:
            used[r.source_id], used[r.target_id] = used.get(r.source_id, 0) + 1, used.get(r.target_id, 0) + 1
            want.add((r.source_id, r.target_id, r.score))
    assert {tuple(r) for r in relations.whole_capped(docs).collect()} == want
    # the bound of 50 had left the folder out
    assert all(28 <= used[f"D{i:02}"] <= 30 for i in range(60))
