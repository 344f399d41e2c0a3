import random

import numpy as np
from pyspark.sql import functions as F

from kbspark.llm.toxicity import FALSE_SHARE, labelled_grams, most_by_chance, segments, source_rates, toxic_documents, toxicity
from kbspark.llm.units import units


def best_by_brute_force(s):
    return max((sum(s[i : j + 1]) for i in range(len(s)) for j in range(i, len(s))), default=0.0)


def test_segments_hold_the_maximum_and_don_t_overlap():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        s = rnd.normal(-0.3, 1, rnd.integers(1, 40))
        got = segments(s)
        if (s > 0).any():
            assert abs(max(x for x, _, _ in got) - best_by_brute_force(s)) < 1e-9
        ends = sorted((a, b) for _, a, b in got)
        assert all(b < c for (_, b), (c, _) in zip(ends, ends[1:]))
        for x, a, b in got:
            assert abs(x - s[a : b + 1].sum()) < 1e-9


def test_units_fold_disguise():
    h = units(["f*ck", "F.C.K", "ｆｃｋ", "sh!t", "shit", "混#蛋", "混蛋", "fuuuck", "fuck"])
    own = [h[0][h[1] == i].tolist() for i in range(9)]
    assert own[0] == own[2] and own[3] == own[4] and own[5] == own[6] and own[7] == own[8]
    assert len(units(["", "!!"])[0]) == 0


def test_held_out_accuracy_and_dirty_rows(spark):
    rnd = random.Random(3)
    plain = ["the records desk moved the pallet", "we counted the pages again", "the ledger is closed", "网络停用与冷链接收推广", "资料管理员转交目录"]
    bad = ["shut up you worthless {}", "go and break your own {} you clown", "闭嘴吧你这蠢{}", "nobody wants your stupid {}"]
    rows, labels = [], []
    for i in range(600):
        parts = [rnd.choice(plain) for _ in range(8)]
        toxic = i % 6 == 0
        if toxic:
            parts.insert(rnd.randrange(8), rnd.choice(bad).format(rnd.choice(["desk", "price", "货"])))
        rows.append((i, ". ".join(parts), [" Wiki ", "wiki", None][i % 3], "x"))
        if i < 300:
            labels.append((i, int(toxic)))
    rows += [(1000, None, "wiki", None), (1001, "", "wiki", None), (1002, " \n", None, None), (None, "x", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score string")
    known = spark.createDataFrame([*labels, (5, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    scored = toxicity(docs, known)
    got = {r.doc_id for r in toxic_documents(scored).collect()}
    want = {i for i in range(300, 600) if i % 6 == 0}
    held = {i for i in got if i >= 300}
    assert len(held & want) >= 0.95 * len(want) and len(held - want) <= 1
    assert scored.count() == len(rows)
    rates = {r.source: r.documents for r in source_rates(scored).collect()}
    assert rates["wiki"] == 402
    assert toxicity(docs.limit(0), known).count() == 0
    for none in (known.limit(0), known.where("toxic = 0")):
        unknown = toxicity(docs, none)
        assert unknown.count() == len(rows) and unknown.where("score > 0 or n_passages > 0").count() == 0


def test_counts_of_labelled_ngrams(spark):
    rows = spark.createDataFrame([("a b a", 1), ("a b", 0), ("", 1), ("b a b", 0)], "text string, toxic int")
    got = {(r.n, r.bad, r.good) for r in labelled_grams(rows).collect()}
    # a, b; a b, b a, and the last unit of a text; the same for three
    assert {x for x in got if x[0] == 1} == {(1, 2, 2), (1, 1, 3)}
    assert sum(r.bad + r.good for r in labelled_grams(rows).collect()) == 3 * 8


def test_found_by_chance_stay_few(spark):
    rows = [(1, 10, 50.0)] * 30 + [(1, 10, 2.0)] * 970
    found = spark.createDataFrame(rows, "doc_id int, n_units int, best double")
    limit = most_by_chance(found, F.exp(-F.col("best")) * 10)
    assert 1e-6 < limit and 1000 * limit <= FALSE_SHARE * 30
    assert most_by_chance(found.limit(0), F.lit(1.0)) == 0.0
