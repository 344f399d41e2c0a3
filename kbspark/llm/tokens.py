"""Encoding of a corpus with a public byte-level BPE tokenizer, as a streaming transducer."""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the public tokenizers lie; a parameter of every operator here.
FOLDER = "/opt/tokenizers"
NAME = "byte_bpe_50k"
#: Fixed value: the split pattern of this tokenizer family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that the pattern may look at from the start of a match before it knows its kind.
PATTERN_LOOKAHEAD = 3
#: Characters that are read at once, and a word's length from which it is read in windows too.
WINDOW, LONG_WORD = 1 << 16, 1 << 13
#: Words and pieces of words that a worker remembers; the memory starts anew when it is full.
REMEMBERED, LONGEST_REMEMBERED = 1 << 18, 64
_NEVER = 1 << 31


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


def read_splits(ranks: dict[bytes, int]) -> np.ndarray:
    """(rank, left, right) of the tokens that arise: by which two tokens each is merged last (single bytes: -1, -1).

    A token whose own bytes are merged into others never arises in any text and is left out.
    """
    out = []
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            joined = [ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
            k = joined.index(min(joined))
            if joined[k] == _NEVER:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        if len(parts) <= 2:
            out.append((rank, *((ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else (-1, -1))))
    return np.array(out, dtype=np.int32).reshape(-1, 3)


class Remembered(dict):
    """A bounded memory of what a function says."""

    def __init__(self, f):
        self.f = f

    def __missing__(self, key):
        value = self.f(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


class Vocabulary:
    """Ranks of a byte-level BPE, and what its merges say about how far a token can still change."""

    def __init__(self, ranks: dict[bytes, int], splits: np.ndarray | None = None, pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        splits = read_splits(ranks) if splits is None else splits
        self.token = {i: b for b, i in ranks.items()}
        self.split = {r: (a, b) for r, a, b in splits.tolist()}
        arise = [self.token[r] for r in self.split]
        #: Bytes a token can have: no text further on can change a boundary so far back, if all
        #: encodings that end within that distance share it.
        self.lookahead = max(map(len, arise))
        #: Beginnings of tokens: only a place from which the text goes on as one of these can
        #: still become the start of a token that is not complete yet.
        self.open = {t[:i] for t in arise for i in range(1, len(t))}
        #: Neighbouring bytes within any token; between two others there always is a boundary,
        #: and one byte of lookahead is sufficient there.
        self.inner = {t[i : i + 2] for t in arise for i in range(len(t) - 1)}
        self.inside = np.zeros(1 << 16, dtype=bool)
        self.inside[[int.from_bytes(x) for x in self.inner]] = True
        self.longest: dict[bytes, int] = {}
        for t in arise:
            self.longest[t[-2:]] = max(len(t), self.longest.get(t[-2:], 0))
        self.follows = lru_cache(1 << 18)(self._follows)
        self.words, self.pieces = Remembered(self._word), Remembered(self._piece)

    def _edge(self, t: int, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at one side of t while it is merged, each with the rank of the merge that takes it in."""
        out, until = [], _NEVER
        while True:
            out.append((self.token[t], until))
            if self.split[t][side] < 0:
                return out[::-1]
            t, until = self.split[t][side], t

    def _follows(self, a: int, b: int) -> bool:
        """Whether b may stand after a: no merge across the boundary comes before those that make up a and b."""
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            across = self.ranks.get(x + y, _NEVER)
            # equal merges go from left to right
            if across < x_until and across <= y_until and across != _NEVER:
                return False
            if x_until == y_until == _NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _word(self, word: str) -> list[int]:
        t = WordTransducer(self)
        return t.feed(word.encode()) + t.finish()

    def remember(self, words: set[str]) -> None:
        """Encode words that are new, cut at all boundaries that no token can cross; what lies between is mostly known."""
        short = [w for w in words if len(w) <= LONGEST_REMEMBERED]
        if not short:
            return
        if len(self.words) + len(short) > REMEMBERED:
            self.words.clear()
        raw = [w.encode() for w in short]
        data, ends = b"".join(raw), np.cumsum([len(r) for r in raw])
        code = np.frombuffer(data, dtype=np.uint8).astype(np.intp)
        cut = np.ones(len(code), dtype=bool)  # whether there is a boundary after a byte
        cut[:-1] = ~self.inside[(code[:-1] << 8) | code[1:]]
        cut[ends - 1] = True
        at = cut.nonzero()[0] + 1
        bounds = at.tolist()
        ids = [self.pieces[data[a:b]] for a, b in zip([0, *bounds], bounds)]
        first = 0
        for w, last in zip(short, np.searchsorted(at, ends, "right").tolist()):
            self.words[w] = ids[first] if last - first == 1 else list(chain.from_iterable(ids[first:last]))
            first = last

    def _piece(self, data: bytes) -> list[int]:
        t = WordTransducer(self)
        t.data += data
        t._advance()
        return t._emit(len(data))


class WordTransducer:
    """Encodes one word, however long: bytes in, final token ids out, memory bounded by the lookahead.

    ``last[i]`` is the last token of the encoding of the first i bytes; it is the only one
    among the tokens ending there that may follow the last token of the bytes before it.
    Tokens go out once stable: at a boundary that no token can cross at once, elsewhere as
    soon as all places where an open token may have begun agree.
    """

    def __init__(self, v: Vocabulary):
        self.v, self.data, self.last = v, bytearray(), [-1]

    def feed(self, chunk: bytes) -> list[int]:
        inner, begin, out = self.v.inner, 0, []
        whole = (bytes(self.data[-1:]) + chunk) if self.data else chunk
        shift = len(whole) - len(chunk)
        for i in range(1, len(whole)):
            if whole[i - 1 : i + 1] not in inner:
                out += self._close(chunk[begin : i - shift])
                begin = i - shift
        for b in range(begin, len(chunk), 1024):
            self.data += chunk[b : b + 1024]
            if len(self.data) > LONGEST_REMEMBERED:
                self._advance()
                out += self._stable()
        return out

    def _close(self, rest: bytes) -> list[int]:
        """Ids of the open bytes and ``rest``, after which there is a boundary in any case."""
        if len(self.last) == 1 and self.last[0] == -1:
            ids = self.v.pieces[bytes(self.data) + rest]
        else:
            self.data += rest
            self._advance()
            ids = self._emit(len(self.data))
        self.data, self.last = bytearray(), [-1]
        return ids

    def _advance(self) -> None:
        data, last = bytes(self.data), self.last
        ranks, split, follows, longest = self.v.ranks, self.v.split, self.v.follows, self.v.longest
        for i in range(len(last), len(data) + 1):
            for j in range(max(0, i - max(1, longest.get(data[max(0, i - 2) : i], 1))), i):
                t = ranks.get(data[j:i])
                if t is not None and t in split and (last[j] == -1 or follows(last[j], t)):
                    last.append(t)
                    break
            else:
                raise ValueError("a byte is no token")

    def _path(self, i: int) -> list[int]:
        ends = []
        while i > 0:
            ends.append(i)
            i -= len(self.v.token[self.last[i]])
        return ends[::-1]

    def _stable(self) -> list[int]:
        """Tokens up to the last boundary that the encodings up to all places share where an open token may begin."""
        n, data, open_ = len(self.data), bytes(self.data), self.v.open
        common = set(self._path(n))
        for i in range(max(0, n - self.v.lookahead + 1), n):
            if data[i:] in open_:
                common &= set(self._path(i))
        return self._emit(max(common, default=0))

    def _emit(self, upto: int) -> list[int]:
        if upto <= 0:
            return []
        ids = [self.last[e] for e in self._path(upto)]
        seen = self.last[upto]
        del self.data[:upto]
        self.last = self.last[upto:]
        self.last[0] = seen  # what follows must still be allowed after it
        return ids

    def finish(self) -> list[int]:
        return self._close(b"")


#: The kinds of characters of which the pattern makes endless words.
_ENDLESS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+")]


class StreamEncoder:
    """Text in, final token ids out; keeps one window and, within endless words, the lookahead."""

    def __init__(self, v: Vocabulary, long_word: int = LONG_WORD):
        self.v, self.long_word, self.text = v, long_word, ""
        self.word: WordTransducer | None = None
        self.more = _ENDLESS[0]

    def _safe(self) -> int:
        """End of the last match that no further text can change.

        A match is final once it ended and its start has been seen with the pattern's
        lookahead. White space is no place to cut at: its last match looks at what follows.
        """
        n, safe = len(self.text), 0
        for m in self.v.pattern.finditer(self.text):
            if m.end() == n or m.start() + PATTERN_LOOKAHEAD > n:
                break
            if not m.group()[-1].isspace():
                safe = m.end()
        return safe

    def feed(self, chunk: str, ended: bool = False) -> list[int]:
        self.text += chunk
        out = self._go_on(ended) if self.word else []
        if self.word:
            return out
        safe = len(self.text) if ended else self._safe()
        out += self._encode(self.text[:safe])
        self.text = self.text[safe:]
        if len(self.text) > self.long_word:
            out += self._open(ended)
        return out

    def _open(self, ended: bool) -> list[int]:
        """Begin an endless word, where what is left is a single match."""
        m = self.v.pattern.match(self.text)
        if m is None or m.end() < len(self.text):
            return []
        self.more = next(p for p in _ENDLESS if p.match(self.text[-1]))
        self.word = WordTransducer(self.v)
        head = self.text[: -PATTERN_LOOKAHEAD]
        self.text = self.text[-PATTERN_LOOKAHEAD:]
        return self.word.feed(head.encode()) + self._go_on(ended)

    def _go_on(self, ended: bool) -> list[int]:
        """Feed the open word as far as it goes; close it where it ends."""
        m = self.more.match(self.text)
        end = m.end() if m else 0
        over = ended or end < len(self.text)
        if self.more is _ENDLESS[2] and (end < len(self.text) or not over):
            end = max(0, end - 1)  # white space before other text leaves its last character to it
        out = self.word.feed(self.text[:end].encode())
        self.text = self.text[end:]
        if over:
            out += self.word.finish()
            self.word = None
        return out

    def _encode(self, text: str) -> list[int]:
        """Ids of whole words, each by the transducer or as remembered from it."""
        words = self.v.pattern.findall(text)
        self.v.remember({w for w in words if w not in self.v.words})
        return list(chain.from_iterable(map(self.v.words.__getitem__, words)))


class StreamDecoder:
    """Token ids in, text out: a byte-to-text state machine that keeps at most three bytes."""

    def __init__(self, v: Vocabulary):
        self.v, self.bytes = v, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids, ended: bool = False) -> str:
        return self.bytes.decode(b"".join(self.v.token[int(i)] for i in ids), ended)


def encode(v: Vocabulary, text: str, window: int = WINDOW) -> list[int]:
    """Ids of one text, read in windows."""
    s = StreamEncoder(v)
    out: list[int] = []
    for begin in range(0, len(text), window):
        out += s.feed(text[begin : begin + window], begin + window >= len(text))
    return out


def lengths(v: Vocabulary, texts: list[str]) -> np.ndarray:
    """How many ids ``encode`` gives for each text, without the ids.

    What lies between two boundaries that no token can cross is worked out once per wording,
    however many words it is part of. Texts longer than a window are encoded.
    """
    out = np.zeros(len(texts), dtype=np.int64)
    some: list[int] = []
    held = 0
    for i, t in enumerate(texts):
        if len(t) > WINDOW:
            out[i] = len(encode(v, t))
        elif t:
            some.append(i)
            held += len(t)
        if some and (held >= 1 << 20 or i + 1 == len(texts)):
            out[some] = _lengths(v, [texts[k] for k in some])
            some, held = [], 0
    return out


def _lengths(v: Vocabulary, texts: list[str]) -> np.ndarray:
    words = [v.pattern.findall(t) for t in texts]
    raw = "".join(texts).encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    # the pattern leaves out no character: where words end, in bytes
    first = np.append(((data & 0xC0) != 0x80).nonzero()[0], len(data))
    ends = first[np.cumsum(np.fromiter(map(len, chain.from_iterable(words)), dtype=np.int64))]
    cut = np.ones(len(data), dtype=bool)
    cut[:-1] = ~v.inside[(data[:-1].astype(np.uint16) << 8) | data[1:]]
    cut[ends - 1] = True
    end = cut.nonzero()[0] + 1
    begin = np.concatenate([[0], end[:-1]])
    size = end - begin
    n = np.ones(len(end), dtype=np.int64)  # a byte is a token
    few = ((size > 1) & (size < 8)).nonzero()[0]
    key = size[few].astype(np.uint64) << np.uint64(56)
    for k in range(7):
        at = (size[few] > k).nonzero()[0]
        key[at] |= data[begin[few[at]] + k].astype(np.uint64) << np.uint64(8 * k)
    _, one, each = np.unique(key, return_index=True, return_inverse=True)
    n[few] = np.array([len(v.pieces[raw[begin[i] : end[i]]]) for i in few[one]], dtype=np.int64)[each]
    for i in (size > 7).nonzero()[0]:
        n[i] = len(v.pieces[raw[begin[i] : end[i]]])
    total = np.concatenate([[0], np.cumsum(n)])
    last = ends[np.cumsum([len(w) for w in words]) - 1]
    return np.diff(total[np.searchsorted(end, last) + 1], prepend=0)


def decode(v: Vocabulary, ids, window: int = WINDOW) -> str:
    s = StreamDecoder(v)
    return "".join(s.feed(ids[b : b + window]) for b in range(0, len(ids), window)) + s.feed([], True)


def share_ranks(spark: SparkSession, folder: str = FOLDER, name: str = NAME) -> Broadcast:
    """The ranks file and its merges (about 2 MB, fixed) for all executors; read once, on the driver."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        raw = f.read()
    return spark.sparkContext.broadcast((raw, _splits(raw)))


@lru_cache(4)
def _splits(raw: bytes) -> bytes:
    return read_splits(read_ranks(raw)).tobytes()


_LOADED: dict[int, Vocabulary] = {}


def vocabulary(shared: tuple[bytes, bytes]) -> Vocabulary:
    """One vocabulary per Python worker."""
    raw, splits = shared
    key = hash(raw)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(read_ranks(raw), np.frombuffer(splits, dtype=np.int32).reshape(-1, 3))
    return _LOADED[key]


def encode_corpus(docs: DataFrame, spark: SparkSession, id_column: str = "doc_id", text_column: str = "text", folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(id, ids) of every row, without special tokens; strings of special tokens are ordinary text.

    Empty and null texts have the ids ``[]``. Rows, ids given twice and null ids are kept as
    they are. No shuffle: each task encodes its own rows, each text in windows.
    """
    shared = share_ranks(spark, folder, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(shared.value)
        for batch in batches:
            for b in range(0, batch.num_rows, 1024):
                part = batch.slice(b, 1024)
                texts = part.column(1).to_pylist()
                ids = [np.asarray(encode(v, t), dtype=np.int32) if t else np.empty(0, np.int32) for t in texts]
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["id", "ids"])

    kind = dict(docs.select(F.col(id_column).alias("id")).dtypes)["id"]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def token_counts(docs: DataFrame, spark: SparkSession, id_column: str = "doc_id", text_column: str = "text", folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(id, tokens) of every row."""
    return encode_corpus(docs, spark, id_column, text_column, folder, name).select(id_column, F.size("ids").cast("bigint").alias("tokens"))


def decode_corpus(encoded: DataFrame, spark: SparkSession, id_column: str = "doc_id", folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(id, text) of every row of ``encode_corpus``; the text of ``[]`` is empty."""
    shared = share_ranks(spark, folder, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(shared.value)
        for batch in batches:
            texts = [decode(v, x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    kind = dict(encoded.select(F.col(id_column).alias("id")).dtypes)["id"]
    return encoded.select(F.col(id_column).alias("id"), "ids").mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_column)
