"""Texts as arrays of word units, for counting and scoring n-grams without per-character Python."""

from __future__ import annotations

import unicodedata

import numpy as np

_SIZE = 0x110000
SPACE, LETTER, DIGIT, HAN, SIGN, NONE = range(6)
#: Signs and digits that stand for letters inside words, and look-alike letters.
_STANDS_FOR = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t", "|": "l", "9": "g", "8": "b"}
_LOOKS_LIKE = dict(zip("аеорсухіјѕкмтнв", "aeopcyxijskmthb"))
#: Signs that are dropped between two letters: they only break up a word.
_BREAKS = "*#._-·~^`'’+/\\_•×=:"


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    fold = np.arange(_SIZE, dtype=np.uint32)
    for i in range(0x10000):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        if 0xFF01 <= i <= 0xFF5E:
            c = chr(i - 0xFEE0)
        low = c.lower()
        c = low if len(low) == 1 else c
        d = unicodedata.decomposition(c)
        if d and not d.startswith("<") and ord(c) < 0x2000:
            c = chr(int(d.split()[0], 16))
        fold[i] = ord(_LOOKS_LIKE.get(c, c))
    kind = np.full(_SIZE, SIGN, dtype=np.uint8)
    for i in range(0x30000):
        if 0xD800 <= i < 0xE000:
            continue
        g = unicodedata.category(chr(i))
        kind[i] = HAN if 0x3400 <= i <= 0x9FFF or 0xF900 <= i <= 0xFAFF or 0x20000 <= i else LETTER if g[0] == "L" else DIGIT if g[0] == "N" else SPACE if g[0] == "Z" or g == "Cc" else NONE if g[0] in "MC" else SIGN
    stands = np.zeros(128, dtype=np.uint32)
    for a, b in _STANDS_FOR.items():
        stands[ord(a)] = ord(b)
    breaks = np.zeros(_SIZE, dtype=bool)
    breaks[[ord(c) for c in _BREAKS]] = True
    return fold, kind, stands, breaks


_T: list = []


def tables():
    """The character tables, built once per Python worker from Unicode's own data."""
    if not _T:
        _T.extend(_tables())
    return _T


def mix(a: np.ndarray, b) -> np.ndarray:
    """One 64-bit hash of two."""
    h = (a ^ (np.uint64(b) if np.isscalar(b) else b)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document index, position) of the units of all texts together, in order.

    A unit is a word of letters and digits or one Han character. Case, width, accents and
    look-alike letters are folded, invisible characters and signs between two letters
    dropped, repeated letters counted once, digits and signs inside a word with letters read as the letters they stand for.
    Positions are code points in the text as it was.
    """
    fold, kind, stands, breaks = tables()
    raw = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    sizes = np.array([len(r) // 4 for r in raw], dtype=np.int64)
    code = np.frombuffer(b"".join(raw), dtype=np.uint32)
    doc = np.repeat(np.arange(len(texts)), sizes)
    pos = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    c = fold[code]
    k = kind[c]
    keep = k != NONE
    c, k, doc, pos = c[keep], k[keep], doc[keep], pos[keep]
    if not len(c):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    wordy = (k == LETTER) | (k == HAN)
    before, after = np.concatenate([[False], wordy[:-1]]), np.concatenate([wordy[1:], [False]])
    keep = ~(breaks[c] & before & after)
    c, k, doc, pos = c[keep], k[keep], doc[keep], pos[keep]
    # a letter that is repeated counts once
    again = np.concatenate([[False], (c[1:] == c[:-1]) & (k[1:] == LETTER) & (doc[1:] == doc[:-1])])
    c, k, doc, pos = c[~again], k[~again], doc[~again], pos[~again]
    # signs that stand for letters count as part of a word between letters
    letter = k == LETTER
    lb, la = np.concatenate([[False], letter[:-1]]), np.concatenate([letter[1:], [False]])
    low = c < 128
    sub = np.zeros(len(c), dtype=np.uint32)
    sub[low] = stands[c[low]]
    inside = (k == SIGN) & (sub > 0) & lb & la
    part = letter | (k == DIGIT) | inside
    new_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
    prev = np.concatenate([[False], part[:-1]])
    start = (part & (~prev | new_doc)) | (k == HAN)
    unit = part | (k == HAN)
    c, doc, pos, start, sub, letter = c[unit], doc[unit], pos[unit], start[unit], sub[unit], letter[unit]
    if not len(c):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    at = start.nonzero()[0]
    word = np.cumsum(start) - 1
    has_letter = np.logical_or.reduceat(letter, at)
    c = np.where(has_letter[word] & (sub > 0), sub, c)
    # polynomial hash of each unit: characters weighted by their place in it
    place = np.arange(len(c)) - at[word]
    h = np.add.reduceat(mix(c.astype(np.uint64), 7) * (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), at)
    return h, doc[at], pos[at]


def grams(h: np.ndarray, doc: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The first ``bits`` bits of the hash of the n-gram that begins at each unit; n-grams don't leave their document."""
    g = mix(h, n)
    for i in range(1, n):
        nxt = np.zeros_like(h)
        nxt[: len(h) - i] = np.where(doc[i:] == doc[: len(h) - i], h[i:], np.uint64(0))
        g = mix(g, nxt + np.uint64(i))
    return (g >> np.uint64(64 - bits)).view(np.int64)
