import random

import numpy as np

from kbspark.llm import neardup
from kbspark.llm.neardup import duplicate_groups, sequences, similar, similar_records

SCHEMA = "source_id string, content string, summary string, text string"


def make(seed=1, n=90):
    rnd = random.Random(seed)
    alphabet = [chr(0x4E00 + i) for i in range(300)] + list("abcdefghij")
    rows, base = [], []
    for i in range(n):
        if base and rnd.random() < 0.6:
            t = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 14)):
                p = rnd.randrange(len(t))
                t[p : p + rnd.randint(0, 2)] = [rnd.choice(alphabet)] * rnd.randint(0, 2)
        else:
            t = [rnd.choice(alphabet) for _ in range(rnd.randint(100, 500))]
        base.append(t)
        rows.append((f"KB-{i:03}", "".join(t), None, "x"))
    rows += [("KB-000", rows[0][1], "other", None), ("KB-COPY", rows[0][1].upper() + " !", None, None), ("KB-BLANK", "  ", rows[1][1], None), (None, rows[1][1], None, None), ("KB-NONE", None, None, None), ("KB-SHORT", "abc", None, None)]
    return rows


def brute(rows):
    texts = {}
    for i, content, summary, _ in rows:
        t = content if content and content.strip() else summary
        t = "".join(c for c in (t or "").lower() if c.isalnum())
        if i and len(t) >= 100:
            texts[i] = {t[k : k + 5] for k in range(len(t) - 4)}
    return {(a, b) for a in texts for b in texts if a < b and len(texts[a] & texts[b]) >= 0.7 * len(texts[a] | texts[b])}


def test_pairs_equal_brute_force(spark):
    rows = make()
    want = brute(rows)
    assert len(want) > 20
    assert {tuple(r) for r in similar_records(spark.createDataFrame(rows, SCHEMA)).collect()} == want


def test_pairs_equal_brute_force_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "STREAMED", 7)
    monkeypatch.setattr(neardup, "COUNTED", 50)
    monkeypatch.setattr(neardup, "COPIES", 3)
    rows = make(2, 60)
    rows += [(f"KB-AGAIN-{i}", rows[5][1], None, None) for i in range(10)]
    assert {tuple(r) for r in similar_records(spark.createDataFrame(rows, SCHEMA)).collect()} == brute(rows)


def test_groups_keep_copies_together(spark):
    rows = make(3, 40)
    got = {r.source_id: r for r in duplicate_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    for a, b in brute(rows):
        assert got[a].group_id == got[b].group_id
    assert got["KB-000"].class_id == got["KB-COPY"].class_id


def test_short_patterns_repeated_equal_brute_force(spark):
    patterns = ["ok", "a", "7", "abc", "xyzw", "abcde", "abcdef", "abcdefg", "标题一二三四", "12345678", "123456789"]
    rows = [(f"KB-{i}-{n}", (p * n)[: 100 + n], None, None) for i, p in enumerate(patterns) for n in (101, 113, 130)]
    rows += [(f"KB-{i}-END", p * 110 + "qr", None, None) for i, p in enumerate(patterns)]
    want = brute(rows)
    assert len(want) > 40
    assert {tuple(r) for r in similar_records(spark.createDataFrame(rows, SCHEMA)).collect()} == want


def test_empty_table(spark):
    assert similar_records(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_filter_is_a_lower_bound():
    rnd = np.random.default_rng(0)
    pairs = []
    for k in range(200):
        x, y = (np.unique(rnd.integers(0, 2 * n, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in (rnd.integers(100, 3000), rnd.integers(100, 3000)))
        if k % 3 == 0:
            x, y = x[: len(x) // 2], np.union1d(x, y[:9])
        pairs.append((neardup._profile(x), neardup._profile(y), len(np.setxor1d(x, y)), len(x) + len(y)))
        assert similar(x, y) == (len(np.intersect1d(x, y)) >= 0.7 * len(np.union1d(x, y)))
    least = neardup.apart_at_least([p[0] for p in pairs], [p[1] for p in pairs])
    assert all(n <= p[2] for n, p in zip(least, pairs))
    # unrelated texts of any size are told apart
    for n in (100, 1000, 9000):
        x, y = (np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)) for _ in range(2))
        assert neardup.apart_at_least([neardup._profile(x)], [neardup._profile(y)])[0] > 0.36 * n
    assert len(sequences("abcd")) == 0


def test_pairs_that_meet_are_not_shuffled(spark):
    """Texts of few phrases all meet at their rarest sequences: what is shuffled grows as the texts, not as their pairs."""

    def shuffled(n):
        rnd = random.Random(5)
        phrases = ["".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(12)) for _ in range(80)]
        rows = [(f"KB-{i}", "".join(rnd.sample(phrases, 30)), None, None) for i in range(n)]
        store = spark.sparkContext._jsc.sc().statusStore()
        before = store.executorList(True).head().totalShuffleWrite()
        similar_records(spark.createDataFrame(rows, SCHEMA)).count()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return store.executorList(True).head().totalShuffleWrite() - before

    few, many = shuffled(300), shuffled(2400)
    assert 0 < many < 8.5 * few
