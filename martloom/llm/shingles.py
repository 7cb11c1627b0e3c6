"""Shingle sets of many texts at once, as sorted 64-bit hashes.

Words are what lies between white space in the UTF-8 text with A-Z in lower case; a shingle is a run
of ``k`` words, and a shorter text is one shingle as a whole. Hashes of 64 bits stand for shingles:
two different shingles of a pair of texts meet with a chance of about 1e-19 a pair of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word. Long texts are taken piece by piece, cut at white space."""
    out = []
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE)
        if end < len(text):
            cut = max(text.rfind(s, at, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut < 0:  # one word longer than a slice: up to its end
                ends = [i for i in (text.find(s, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if i >= 0]
                cut = min(ends, default=len(text))
            end = cut
        out.append(_hashes(text[at:end]))
        at = max(end, at + 1)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


_LETTER = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])


def _hashes(piece: bytes) -> np.ndarray:
    return _spans(piece)[0]


def _spans(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and where it starts."""
    codes = np.frombuffer(b" " + piece.lower() + b" ", np.uint8)
    letter = _LETTER[codes]
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    size = end - start
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    at = np.flatnonzero(letter)
    powers = np.multiply.accumulate(np.full(int(size.max()), _BASE, np.uint64))
    terms = (codes[at].astype(np.uint64) + np.uint64(1)) * powers[at - np.repeat(start, size)]
    return mix(np.add.reduceat(terms, first)), start - 1


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; empty without a word."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(words):
        return words
    n = min(k, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix(h * _ODD + words[i : len(words) - n + 1 + i])
    return np.unique(h)


def shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of many texts end to end, each as ``shingle_set`` gives it, and their sizes.

    Texts are taken together up to ``SLICE`` bytes, so that short ones don't cost a pass each.
    """
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    out = [_many(data[a:b], k) for a, b in groups([len(d) for d in data], SLICE)]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.uint64), np.zeros(0, int))


def word_sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text its number of words and a hash of their sequence, 0 without a word."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    out = [_sequences(*_words(data[a:b])) for a, b in groups([len(d) for d in data], SLICE)]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, np.uint64))


def _words(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts end to end, and how many each has."""
    if len(data) == 1:
        words = word_hashes(data[0])
        return words, np.array([len(words)])
    begin = np.concatenate(([0], np.cumsum([len(d) + 1 for d in data])))
    words, at = _spans(b"\n".join(data))
    return words, np.diff(np.searchsorted(at, begin))


def _sequences(words: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sum of the words' hashes, each mixed with its place."""
    first = np.cumsum(count) - count
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(first, count).astype(np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words + mix(place + _BASE)))))
    text = mix(total[first + count] - total[first] + count.astype(np.uint64))
    return count, text * (count > 0).astype(np.uint64)


def _many(data: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    words, count = _words(data)
    size = np.minimum(k, count)
    made = np.where(count, count - size + 1, 0)
    first, last = np.cumsum(count) - count, np.cumsum(made)
    at = np.arange(made.sum()) + np.repeat(first - (last - made), made)
    n = np.repeat(size, made)
    h = n.astype(np.uint64)
    for i in range(k):
        some = n > i  # texts of fewer than k words are one shingle
        if some.all():
            h = mix(h * _ODD + words[at + i])
        else:
            h[some] = mix(h[some] * _ODD + words[at[some] + i])
    for a, b in zip((last - made).tolist(), last.tolist()):
        h[a:b].sort()
    owner = np.repeat(np.arange(len(data)), made)
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(data))


def groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to at most ``limit`` (or one item)."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
