"""Texts as numpy arrays: blocks of an Arrow column, words, shingles and their 64-bit hashes.

Everything works on the UTF-8 bytes of many texts at once. A block holds whole texts only, so memory
follows the block size, or the longest single text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
U64 = np.uint64

#: The bytes between words are space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Anything but ASCII letters, digits and bytes of longer characters.
PUNCT = np.ones(256, bool)
PUNCT[48:58] = PUNCT[65:91] = PUNCT[97:123] = PUNCT[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=U64))


@lru_cache(maxsize=4)
def _powers(size: int, inverse: bool) -> np.ndarray:
    powers = np.full(size, _INV if inverse else _MULT, U64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _power(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the multiplier, or of its inverse, modulo 2^64."""
    return _powers(max(BLOCK // 2, 1 << n.bit_length()), inverse)[:n]


class Rolling:
    """Hash of any slice of a sequence in constant time, from prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(values * _power(n), out=self.sums[1:])
        self.inverse = _power(n + 1, True)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def rolling(data: np.ndarray) -> Rolling:
    return Rolling(_VALUES[data])


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"").cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; no word crosses from one text to the next."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~sep[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    a, b = offsets[:-1][filled], offsets[1:][filled] - 1
    first[a], last[b] = inside[a], inside[b]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Words:
    """Words of a block: spans, 64-bit hashes, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = SPACE, fold: bool = True):
        self.start, self.end = word_spans(data, offsets, sep)
        self.hash = rolling(LOWER[data] if fold else data).of(self.start, self.end)
        self.bounds = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.bounds)

    def __len__(self) -> int:
        return len(self.start)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n items from each place on; len - n + 1 of them."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = hashes[:m].copy()
    for i in range(1, n):
        out *= U64(_MULT)
        out += hashes[i : i + m]
    return mix(out + U64(n))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every n-word shingle, repeats included; a shorter text is one shingle of all its words."""
    counts = words.counts
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - words.bounds[:-1][text]
    full = grams(words.hash, n)
    keep = (place[: len(full)] + n <= counts[text[: len(full)]]) if len(full) else np.zeros(0, bool)
    out_text, out_hash = [text[: len(full)][keep]], [full[keep]]
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            at = words.bounds[short]
            h = words.hash[at].copy()
            for i in range(1, size):
                h = h * U64(_MULT) + words.hash[at + i]
            out_text.append(short)
            out_hash.append(mix(h + U64(size)))
    return np.concatenate(out_text), np.concatenate(out_hash)


def distinct(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, hash) pairs, sorted."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs that begin at ``starts``, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
