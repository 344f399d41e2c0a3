import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kbspark.llm import grouping
from kbspark.llm.grouping import connected_groups, verdict_groups
from kbspark.plans.lineage import cut, shared_folder


def union_find(pairs):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "hub"])
def test_groups_equal_union_find(spark, kind):
    rnd = random.Random(5)
    pairs = {
        "random": [(f"{rnd.randrange(300):03}", f"{rnd.randrange(300):03}") for _ in range(220)] + [("x", "x"), (None, "y"), ("y", None)],
        "chain": [(f"{i:04}", f"{i + 1:04}") for i in range(5000)],
        "star": [("hub", f"{i:04}") for i in range(400)] * 2,
        # one vertex has a tenth of the edges and more than are joined in one piece
        "hub": [("h", f"{rnd.randrange(900):03}") for _ in range(100)] + [(f"{rnd.randrange(900):03}", f"{rnd.randrange(900):03}") for _ in range(900)],
    }[kind]
    got = {r.id: r.group_id for r in connected_groups(spark.createDataFrame(pairs, "a string, b string"), split=16 if kind == "hub" else 100_000).collect()}
    assert got == union_find(pairs)


def test_no_links(spark):
    assert connected_groups(spark.createDataFrame([], "a string, b string")).count() == 0


def test_latest_verdict_counts(spark):
    t = [datetime(2026, 1, d) for d in (1, 2)]
    rows = [
        ("r1", " kb-1", "KB-2　", "Confirmed ", "完全重复\n", t[0]),
        ("r2", "KB-2", "KB-3", "confirmed", "版本关系", t[0]),
        ("r2", "KB-2", "KB-3", "rejected", "版本关系", t[1]),
        ("r3", "KB-4", "KB-4", "confirmed", "完全重复", t[0]),
        ("r4", "KB-5", None, "confirmed", "完全重复", t[0]),
        ("r5", "KB-6", "KB-7", "confirmed", None, t[0]),
        (None, "KB-8", "KB-9", "confirmed", "完全重复", None),
        (None, "KB-9", "KB-a", "confirmed", "完全重复", None),
    ]
    df = spark.createDataFrame(rows, "relation_id string, source_id string, target_id string, verification_status string, verified_relation_type string, verified_at timestamp").withColumn("group_id", F.lit("x")).withColumn("a", F.lit(1))
    got = {tuple(r) for r in verdict_groups(df).collect()}
    assert got == {("KB-1", "KB-1"), ("KB-2", "KB-1"), ("KB-8", "KB-8"), ("KB-9", "KB-8"), ("KB-A", "KB-8")}


def test_plan_grows_in_proportion_to_the_rounds(spark):
    """The state is named once a round, however many rounds one written table takes."""
    links = spark.createDataFrame([(f"{i}", f"{i + 1}") for i in range(9)], "a string, b string")
    adjacency, parted = grouping._adjacency(links, 0, 0.2, 100)
    sizes = []
    for rounds in (1, 2, 3, 4):
        plans = []
        with pytest.MonkeyPatch.context() as m:
            m.setattr(grouping, "ROUNDS", rounds)
            m.setattr(grouping, "cut", lambda df, tag: plans.append(df) or cut(df, tag))
            grouping._grown(adjacency, parted)
        sizes.append(plans[0]._jdf.queryExecution().analyzed().toString().count("Aggregate"))
    assert sizes == [1, 2, 3, 4]


def test_nothing_but_the_result_is_left(spark):
    folder = shared_folder(spark).removeprefix("file://") + "/kbspark"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    connected_groups(spark.createDataFrame([(f"{i}", f"{i + 1}") for i in range(9)], "a string, b string")).count()
    assert len(set(os.listdir(folder)) - before) == 1
