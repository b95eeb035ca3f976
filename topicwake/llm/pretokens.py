"""Texts split into the pre-tokens of two public tokenizers, as arrays, and a cache from pre-token to ids.

A pre-token is merged on its own, so equal ones have equal ids wherever they stand. A block of texts is
split at once with class tables of its characters; each distinct pre-token is then looked up or encoded
once. Texts with characters outside the tables, or with a special token's string, go to the slow splitter.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np

from topicwake.llm.text import U64, Rolling, mix, ragged

OTHER, LETTER, NUMBER, BLANK, UNSAFE = range(5)
_PLAIN = 0x250  # beyond Latin, libraries may know other versions of the character tables


def _classes() -> np.ndarray:
    table = np.full(0x110000, UNSAFE, np.uint8)
    for c in [*range(0x20, 0x7F), *range(0xA1, _PLAIN), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]:
        kind = unicodedata.category(chr(c))[0]
        table[c] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    table[[0x20, 9, 10, 13]] = BLANK
    return table


def _lower() -> np.ndarray:
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(_PLAIN):
        low = chr(c).lower()
        table[c] = ord(low) if len(low) == 1 and ord(low) < _PLAIN else 0xFFFF
    return table


class Split:
    """Pre-tokens of a block: spans in ``chars``, hashes, and where each text's begin.

    ``slow`` marks the texts that were left out.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, tables: Tables, specials: tuple[bytes, ...]):
        raw = data.tobytes()
        chars = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        self.offsets = np.searchsorted(lead, offsets)
        if tables.lower is not None:
            chars = tables.lower[chars]
        self.chars = chars
        kind = tables.kinds[chars]
        n = len(offsets) - 1
        self.slow = np.zeros(n, bool)
        bad = np.flatnonzero(kind == UNSAFE)
        if len(bad):
            self.slow[np.searchsorted(self.offsets, bad, "right") - 1] = True
        for special in specials:
            at = raw.find(special)
            while at >= 0:
                self.slow[np.searchsorted(offsets, at, "right") - 1] = True
                at = raw.find(special, at + 1)
        self.start, self.end = tables.spans(chars, kind, self.offsets)
        self.text = np.searchsorted(self.offsets, self.start, "right") - 1
        fast = ~self.slow[self.text]
        self.start, self.end, self.text = self.start[fast], self.end[fast], self.text[fast]
        self.bounds = np.searchsorted(self.text, np.arange(n + 1))
        self.hash = Rolling(mix(chars.astype(U64) + U64(1))).of(self.start, self.end)

    def utf8(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the given pre-tokens, one after the other, and how many each has."""
        size = self.end[rows] - self.start[rows]
        chars = self.chars[ragged(self.start[rows], size)]
        width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        before = np.append(0, np.cumsum(width))
        ends = np.cumsum(size)
        data = np.frombuffer(chars.tobytes().decode("utf-32-le").encode(), np.uint8)
        return data, before[ends] - before[ends - size]


def _runs(kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True where a run of one class, or a text, begins."""
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[offsets[:-1][offsets[:-1] < len(kind)]] = True
    return first


def _contractions(chars, kind, first, offsets) -> tuple[np.ndarray, np.ndarray]:
    """Places and lengths of 's 't 're 've 'm 'll 'd, each a run of one apostrophe before letters."""
    n = len(chars)
    at = np.flatnonzero((chars == 39) & first)
    at = at[at + 1 < n]
    at = at[first[at + 1] & (kind[at + 1] == LETTER) & ~np.isin(at + 1, offsets)]
    one = chars[at + 1]
    single = np.isin(one, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
    inner = at + 2 < n
    two = np.where(inner, chars[np.minimum(at + 2, n - 1)], 0)
    same = inner & ~first[np.minimum(at + 2, n - 1)]
    double = same & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
    hit = single | double
    return at[hit], np.where(single, 2, 3)[hit]


class Tables:
    """Character classes and the rule that finds pre-tokens."""

    def __init__(self, words_only: bool):
        self.kinds, self.lower = _classes(), _lower() if words_only else None
        self.spans = self._words if words_only else self._tiles

    @staticmethod
    def _tiles(chars, kind, offsets):
        """Runs of one class, each with the space before it; of other white space only the last stands alone."""
        n = len(chars)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = _runs(kind, offsets)
        text_start = np.zeros(n + 1, bool)
        text_start[offsets] = True
        blank = kind == BLANK
        start = first & blank
        last = blank.copy()
        last[:-1] &= ~blank[1:] & ~text_start[1:-1]
        last[-1] = False
        start |= last
        glued = np.zeros(n, bool)
        glued[1:] = chars[:-1] == 32
        glued &= ~text_start[:-1]
        start |= first & ~blank & ~glued
        at, size = _contractions(chars, kind, first, offsets)
        free = ~glued[at]
        at, size = at[free], size[free]
        start[at + 1] = False
        after = at + size
        start[after[after < n]] = True
        begin = np.flatnonzero(start)
        return begin, np.append(begin[1:], n)

    @staticmethod
    def _words(chars, kind, offsets):
        """Runs of letters, single digits and runs of other signs; white space falls away."""
        n = len(chars)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = _runs(kind, offsets) | (kind == NUMBER)
        at, size = _contractions(chars, kind, first, offsets)
        first[at + 1] = False
        after = at + size
        inside = after[after < n]
        first[inside] = True
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], n)
        keep = kind[begin] != BLANK
        return begin[keep], end[keep]


class IdCache:
    """Ids of pre-tokens by hash; emptied when ``limit`` pre-tokens are held."""

    def __init__(self, encode: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], limit: int = 300_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.place: dict[int, int] = {}
        self.starts, self.lengths = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0

    def _add(self, keys: list[int], ids: np.ndarray, size: np.ndarray) -> None:
        n, total = len(self.place), len(ids)
        while n + len(keys) > len(self.starts):
            self.starts, self.lengths = (np.resize(x, 2 * len(x)) for x in (self.starts, self.lengths))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.starts[n : n + len(keys)] = self.used + np.cumsum(size) - size
        self.lengths[n : n + len(keys)] = size
        self.ids[self.used : self.used + total] = ids
        self.used += total
        self.place.update(zip(keys, range(n, n + len(keys))))

    def places(self, split: Split) -> np.ndarray:
        """For each pre-token its row in ``starts`` and ``lengths``."""
        keys, first, inverse = np.unique(split.hash, return_index=True, return_inverse=True)
        if len(self.place) + len(keys) > self.limit:
            self._clear()
        keys = keys.tolist()
        found = [self.place.get(k, -1) for k in keys]
        rows = np.array(found, np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = len(self.place) + np.arange(len(new))
            self._add([keys[i] for i in new.tolist()], *self.encode(*split.utf8(first[new])))
        return rows[inverse]

    def ids_of(self, split: Split) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the block, number of ids of each text); texts marked slow have none."""
        rows = self.places(split)
        size = self.lengths[rows].astype(np.int64)
        before = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(size, out=before[1:])
        return self.ids[ragged(self.starts[rows], size)], np.diff(before[split.bounds])
