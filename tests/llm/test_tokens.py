import os
import random

import pytest
import tiktoken

from kbspark.llm import tokens
from kbspark.llm.tokens import FOLDER, NAME, PATTERN, StreamEncoder, Vocabulary, WordTransducer, decode, decode_corpus, encode, encode_corpus, lengths, read_ranks

pytestmark = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/{NAME}.tiktoken"), reason="no tokenizer files")
PARTS = ["a", "the", "ing", " ", "  ", "\n", "\t", "'s", "'l", "'ll", "了", "审计", "é", "😀", "12", "!", "==", "-", "　", "ñ", "'r", "'"]


@pytest.fixture(scope="module")
def v():
    with open(f"{FOLDER}/{NAME}.tiktoken", "rb") as f:
        return Vocabulary(read_ranks(f.read()))


@pytest.fixture(scope="module")
def library(v):
    """The tokenizer's own library, for comparison only."""
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=v.ranks, special_tokens={})


@pytest.mark.parametrize("seed", range(8))
def test_any_chunks_give_the_same_ids(v, library, seed):
    rnd = random.Random(seed)
    for _ in range(120):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60)))
        s = StreamEncoder(v, rnd.choice([3, 6, 100_000]))
        w, out = rnd.randint(1, 9), []
        for b in range(0, len(text), w):
            out += s.feed(text[b : b + w])
        out += s.feed("", True)
        assert out == library.encode_ordinary(text)
        assert decode(v, out, 3) == text


@pytest.mark.parametrize("word", ["a" * 9000, "的" * 4000, "=" * 9000, "ab" * 4000, "thequickbrownfox" * 400])
def test_endless_words_in_bounded_memory(v, library, word):
    t, raw, out, most = WordTransducer(v), word.encode(), [], 0
    for b in range(0, len(raw), 700):
        out += t.feed(raw[b : b + 700])
        most = max(most, len(t.last))
    assert out + t.finish() == library._encode_single_piece(raw)
    assert most < 4 * v.lookahead


def test_words_of_any_bytes(v, library):
    rnd = random.Random(7)
    shared = [b for b in v.ranks if 2 <= len(b) <= 6]
    for _ in range(4000):
        raw = b"".join(rnd.choice([bytes([rnd.randrange(256)]), rnd.choice(shared)]) for _ in range(rnd.randint(1, 12)))
        t, out = WordTransducer(v), []
        for b in range(0, len(raw), 3):
            out += t.feed(raw[b : b + 3])
        assert out + t.finish() == library._encode_single_piece(raw)


def test_a_full_memory_changes_nothing(v, library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    text = "审计终稿清楚，the end of it all. naïve coöperation 😀" * 20
    assert encode(Vocabulary(v.ranks), text) == library.encode_ordinary(text)


def test_the_library_has_no_part_in_it():
    assert not hasattr(tokens, "tiktoken")


def test_windows_of_a_long_text(v, library):
    text = "审计终稿清楚，the end. " * 9000
    assert encode(v, text, 1000) == library.encode_ordinary(text)


def test_operator_on_dirty_rows(spark):
    rows = [(1, "the end", "x"), (1, "the end", "y"), (2, "", None), (3, None, None), (None, " <|endoftext|>", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = encode_corpus(df, spark)
    assert sorted((r.doc_id or 0, tuple(r.ids)) for r in out.collect())[1:] == [(1, (1169, 886)), (1, (1169, 886)), (2, ()), (3, ())]
    assert sorted(r.text for r in decode_corpus(out, spark).collect()) == ["", "", " <|endoftext|>", "the end", "the end"]
    assert encode_corpus(df.limit(0), spark).count() == 0


def test_lengths_are_those_of_the_ids(v, monkeypatch):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice([*PARTS, "\0", "\0a"]) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    texts += ["", "a" * 9000, "的" * 4000, " " * 700, "thequickbrownfox" * 400, ""]
    want = [len(encode(v, t)) for t in texts]
    assert lengths(v, texts).tolist() == want
    monkeypatch.setattr(tokens, "WINDOW", 20)
    assert lengths(v, texts).tolist() == want
    assert lengths(v, []).tolist() == [] and lengths(v, [""]).tolist() == [0]


def test_documents_to_be_mixed_are_counted_without_their_ids(spark, v, monkeypatch):
    import numpy as np

    from kbspark.llm import mixing

    rows = [(i, f"alpha {i} 审计 beta", ["big", None][i % 2]) for i in range(40)] + [(40, None, "big")]
    members = mixing.memberships(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark, ["big"], np.array([1.0]))
    assert {r.doc_id: r.tokens for r in members.collect()} == {i: len(encode(v, t or "")) for i, t, _ in rows}
    assert not hasattr(mixing, "encode")
