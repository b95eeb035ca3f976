"""Two-stage suffix sorting of a text made of separate pieces, up to a fixed depth."""

from __future__ import annotations

import numpy as np

from topicwake.llm.text import ragged


def join(pieces: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, first symbol of each piece): bytes plus one, a 0 after every piece and a margin of zeros.

    The byte 0xFF, which no UTF-8 text holds, would become a 0 as well.
    """
    n = len(sizes)
    starts = np.cumsum(sizes) - sizes + np.arange(n)
    symbols = np.zeros(int(sizes.sum()) + n + depth + 16, np.uint8)
    symbols[ragged(starts, sizes)] = pieces + np.uint8(1)
    return symbols, starts


def smaller_than_next(symbols: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that starts at its successor; equal symbols take the next one's side."""
    differs = np.append(symbols[:-1] != symbols[1:], True)
    place = np.where(differs, np.arange(len(symbols)), len(symbols))
    decides = np.minimum.accumulate(place[::-1])[::-1]
    after = symbols[np.minimum(decides + 1, len(symbols) - 1)]
    return symbols < after


def _words(symbols: np.ndarray) -> np.ndarray:
    """Eight symbols from each place on as one big-endian number."""
    n = len(symbols) - 8
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out |= symbols[k : k + n].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def _direct(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their first ``depth`` symbols, eight at a time; only groups that split are sorted again."""
    places = places[np.argsort(words[places], kind="stable")]
    key = words[places]
    new = np.append(True, key[1:] != key[:-1])
    for step in range(8, depth, 8):
        single = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~single)
        if not len(open_):
            break
        group = np.cumsum(new)[open_]
        key = words[np.minimum(places[open_] + step, len(words) - 1)]
        same = group[1:] == group[:-1]
        differ = np.append(False, same & (key[1:] != key[:-1]))
        if not differ.any():
            continue
        split = np.isin(group, group[differ])
        at, group, key = open_[split], group[split], key[split]
        order = np.lexsort((key, group))
        places[at] = places[at[order]]
        key, group = key[order], group[order]
        new[at[1:][(key[1:] != key[:-1]) & (group[1:] == group[:-1])]] = True
    return places


def sort_suffixes(symbols: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The places marked in ``wanted`` in the order of their suffixes; equal to ``depth`` symbols means next to each other.

    First stage: suffixes smaller than their successors are sorted directly. Second stage: buckets of a
    first symbol are scanned from the smallest; each place found hands its predecessor, if that is greater
    than its successor, to the end of that one's bucket. A bucket is scanned as a whole, in as many turns as
    its symbol repeats. Places between a wanted one and the next directly sorted one take part as well.
    """
    small = smaller_than_next(symbols)
    part = wanted.copy()
    at = np.flatnonzero(wanted[:-1] & ~wanted[1:] & ~small[:-1])  # where a wanted run ends before a sorted place
    nearest = np.minimum.accumulate(np.where(small | (symbols == 0), np.arange(len(symbols)), len(symbols))[::-1])[::-1]
    ends = np.minimum(nearest[at], len(symbols) - 1)
    part[ragged(at, ends - at + 1)] = True
    stops = np.flatnonzero(part & (small | (symbols == 0)))
    direct = _direct(stops, _words(symbols), depth)
    first = symbols[direct]
    edges = np.searchsorted(first, np.arange(257))
    hand = part & ~small & (symbols != 0)
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        turn = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        greater = [turn]
        while len(turn):
            before = turn[turn > 0] - 1
            turn = before[hand[before] & (symbols[before] == c)]
            greater.append(turn)
        bucket = np.concatenate([*greater, direct[edges[c] : edges[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[hand[before] & (symbols[before] > c)]
        if len(before):
            target = symbols[before]
            order = np.argsort(target, kind="stable")
            target, before = target[order], before[order]
            cuts = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
            for k, x in zip(target[cuts].tolist(), np.split(before, cuts[1:])):
                induced[k].append(x)
    found = np.concatenate(out)
    return found[wanted[found]]


def share_with_neighbour(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For places in suffix order: True where ``depth`` symbols agree with the place before or after."""
    words = _words(symbols)
    equal = np.ones(max(len(order) - 1, 0), bool)
    for step in [*range(0, depth - 7, 8), *([depth - 8] if depth % 8 else [])]:
        live = np.flatnonzero(equal)
        if not len(live):
            break
        equal[live] = words[order[live] + step] == words[order[live + 1] + step]
    out = np.zeros(len(order), bool)
    out[:-1] |= equal
    out[1:] |= equal
    return out
