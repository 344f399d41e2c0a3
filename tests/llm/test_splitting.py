import random

import pytest

from kbspark.llm.splitting import boundaries, oversized_ids, pieces, split_oversized


def check(text, limit, overlap):
    got = pieces(text, limit, overlap)
    shared = max(0, min(overlap, limit - 1))
    assert got[0][0] == 0 and got[-1][1] == len(text)
    assert all(0 < e - s <= limit for s, e, _ in got)
    for (_, e, _), (s, e2, _) in zip(got, got[1:]):
        assert s == e - shared and e2 > e
    assert text[: got[0][1]] + "".join(text[s + shared : e] for s, e, _ in got[1:]) == text
    return got


@pytest.mark.parametrize("seed", range(40))
def test_pieces_round_trip(seed):
    rnd = random.Random(seed)
    for _ in range(40):
        text = "".join(rnd.choice("ab。\n# .é́c\r😀") for _ in range(rnd.randint(1, 200)))
        check(text, rnd.randint(1, 30), rnd.randint(0, 35))


@pytest.mark.parametrize("seed", range(10))
def test_hard_cuts_only_out_of_reach(seed):
    rnd = random.Random(seed)
    text = "".join("x" * rnd.choice([3, 8, 40]) + rnd.choice(["。", "\n", "\n\n"]) for _ in range(40))
    limit, overlap = 20, 4
    natural = sorted(boundaries(text))
    got = check(text, limit, overlap)
    cuts = [overlap] + [e for _, e, _ in got]
    for last, (_, e, kind) in zip(cuts, got):
        if kind == "hard":
            assert not [p for p in natural if last < p <= last + limit - overlap]


def test_pieces_are_even_and_prefer_headings():
    text = "\n\n".join(f"# Part {i}\n" + "One sentence. " * 40 for i in range(8))
    got = check(text, 1300, 50)
    assert {k for _, _, k in got[:-1]} == {"heading"}
    sizes = [e - s for s, e, _ in got]
    assert min(sizes) > 0.4 * max(sizes)


def test_very_long_text():
    check("word. " * 60_000 + "z" * 20_000, 3000, 200)


def test_operator_on_dirty_rows(spark):
    texts = spark.createDataFrame(
        [(" kb-1 ", ".MD", "a" * 25, 1), ("KB-1", "md", "a" * 25, 2), ("KB-2", "md", "a" * 10, 1), ("KB-3", None, "b" * 31, 1), ("KB-4", "md", None, 1), ("KB-5", "md", "", 1), (None, "md", "c" * 11, 1)],
        "source_id string, extension string, content string, max_chars int",
    )
    limits = spark.createDataFrame([("md", 10, 2), ("md", 12, 2), ("*", 30, None), ("pdf", None, 1)], "extension string, max_chars long, overlap_chars long")
    out = split_oversized(texts, limits)
    assert {r.source_id for r in oversized_ids(out).collect()} == {"KB-1", "KB-3"}
    one = sorted((r.piece_no, r.piece) for r in out.where("source_id = 'KB-1'").collect())
    assert [p for p, _ in one] == list(range(len(one)))
    assert one[0][1] + "".join(p[2:] for _, p in one[1:]) == "a" * 25
    assert out.where("source_id is null").count() > 1
    assert split_oversized(texts, limits.where("extension = 'pdf'")).count() == 0
    assert split_oversized(texts.limit(0), limits).count() == 0
