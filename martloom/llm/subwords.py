"""Words and hashed character n-grams of many texts at once, as numpy arrays.

A word is a run of letters and marks, in lower case. Its n-grams run over the word with one boundary
sign on either side; the word as a whole is one more feature. Texts are taken in slices of bounded size,
cut where no word is; only a single word longer than a slice is cut in itself.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SLICE = 1 << 18
_BREAK = re.compile(r"[^\w][\w]*\Z", re.S)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point of the basic plane: whether it makes part of a word, its lower case."""
    word = np.zeros(0x10000, bool)
    lower = np.arange(0x10000, dtype=np.uint32)
    for i in range(0x10000):
        c = chr(i)
        word[i] = unicodedata.category(c)[0] in "LM"
        small = c.lower()
        if len(small) == 1:
            lower[i] = ord(small)
    return word, lower


@dataclass
class Slice:
    """Texts laid end to end. Positions index ``codes``; a word is [start, end)."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # of each word, the index of its text
    offset: np.ndarray  # of each word, its code point offset within the text

    @functools.cached_property
    def letters(self) -> np.ndarray:
        """Positions of all letters, word by word."""
        n = self.end - self.start
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        return np.arange(n.sum()) - np.repeat(first - self.start, n)

    @functools.cached_property
    def first_letter(self) -> np.ndarray:
        n = self.end - self.start
        return np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)

    def grams(self, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Per letter the bucket of the n-gram around it and whether the word is long enough."""
        at = self.letters
        left = np.repeat(self.end, self.end - self.start) - at
        h = np.full(len(at), n, np.uint64)
        last = len(self.codes) - 1
        for k in range(-1, n - 1):
            h = (h + self.codes[np.minimum(at + k, last)]) * _MIX
            h ^= h >> np.uint64(29)
        return (h >> np.uint64(64 - bits)).astype(np.int64), left >= n - 2

    def words(self, bits: int) -> np.ndarray:
        """Bucket of each whole word."""
        if not len(self.start):
            return np.zeros(0, np.int64)
        n = self.end - self.start
        powers = np.full(int(n.max()), np.uint64(0x100000001B3), np.uint64)
        powers = np.multiply.accumulate(powers)
        within = self.letters - np.repeat(self.start, n)
        h = np.add.reduceat(self.codes[self.letters] * powers[within], self.first_letter)
        h = (h ^ (h >> np.uint64(31))) * _MIX
        return (h >> np.uint64(64 - bits)).astype(np.int64)

    def per_word(self, per_letter: np.ndarray) -> np.ndarray:
        return np.add.reduceat(per_letter, self.first_letter, axis=0)


def _pieces(texts: list[str]) -> Iterator[tuple[int, int, str]]:
    """(text, offset, piece) with pieces of at most a slice."""
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > SLICE:
            cut = _BREAK.search(text, at + SLICE // 2, at + SLICE)
            end = cut.start() + 1 if cut else at + SLICE
            yield i, at, text[at:end]
            at = end
        yield i, at, text[at:]


def _slice(pieces: list[tuple[int, int, str]]) -> Slice:
    word, lower = tables()
    whole = " " + " ".join(p[2] for p in pieces) + " "
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    basic = np.minimum(codes, 0xFFFF)
    mask = word[basic]
    codes = lower[basic]
    if (far := np.flatnonzero(basic == 0xFFFF)).size:
        real = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)[far]
        kinds = {int(c): unicodedata.category(chr(c))[0] in "LM" for c in np.unique(real)}
        mask[far] = [kinds[int(c)] for c in real]
        codes[far] = real
    codes = np.where(mask, codes, np.uint32(1)).astype(np.uint64)
    edge = np.diff(mask.astype(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    begins = np.cumsum([1] + [len(p[2]) + 1 for p in pieces])[:-1]
    piece = np.searchsorted(begins, start, "right") - 1
    doc = np.array([p[0] for p in pieces], np.int64)[piece]
    offset = start - begins[piece] + np.array([p[1] for p in pieces], np.int64)[piece]
    return Slice(codes, start, end, doc, offset)


def slices(texts: list[str]) -> Iterator[Slice]:
    held: list[tuple[int, int, str]] = []
    size = 0
    for piece in _pieces(texts):
        if held and size + len(piece[2]) > SLICE:
            yield _slice(held)
            held, size = [], 0
        held.append(piece)
        size += len(piece[2]) + 1
    if held:
        yield _slice(held)
