"""Simple-8b: 64-bit words of a 4-bit selector and as many equally wide values as fit in 60 bits."""

from __future__ import annotations

import numpy as np

from topicwake.llm.text import U64

#: (values, bits each) by selector; selector 14 stands for a value of over 60 bits, kept in a list of escapes.
PACKINGS = [
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
ESCAPE = len(PACKINGS)
COUNTS = np.array([c for c, _ in PACKINGS] + [1], np.int64)
#: Values in a run that begins at a word of its own.
RUN = 1024
_LIMITS = np.array([(1 << b) for b in range(61)], U64)


def _selectors(values: np.ndarray) -> np.ndarray:
    """For every place of each run (a row) the selector that packs most values from there on."""
    width = np.searchsorted(_LIMITS, values, "right").astype(np.uint8)
    rows, n = width.shape
    padded = np.zeros((rows, n + 64), np.uint8)
    padded[:, :n] = width
    tops = {1: padded}
    for size in (1, 2, 4, 8, 16):
        wide = tops[size].copy()
        np.maximum(wide[:, :-size], tops[size][:, size:], out=wide[:, :-size])
        tops[2 * size] = wide
    out = np.full((rows, n), ESCAPE, np.uint8)
    for selector in range(len(PACKINGS) - 1, -1, -1):
        count, bits = PACKINGS[selector]
        part = 1 << (count.bit_length() - 1)
        top = np.maximum(tops[part][:, :n], tops[part][:, count - part : count - part + n])
        out[top <= bits] = selector
    return out


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, words of each run of ``RUN`` values, escapes) of unsigned 64-bit values."""
    n = len(values)
    runs = -(-n // RUN)
    if not runs:
        return np.zeros(0, U64), np.zeros(0, np.uint32), np.zeros(0, U64)
    grid = np.zeros((runs, RUN), U64)
    grid.ravel()[:n] = values
    ends = np.full(runs, RUN)
    ends[-1] = n - RUN * (runs - 1)
    chosen = _selectors(grid)
    at, alive, steps = np.zeros(runs, np.int64), np.arange(runs), []
    while len(alive):  # all runs go forward together, a word at a time
        selector = chosen[alive, at]
        steps.append((alive, at, selector))
        at = at + COUNTS[selector]
        more = at < ends[alive]
        alive, at = alive[more], at[more]
    run = np.concatenate([x[0] for x in steps])
    place = np.concatenate([x[1] for x in steps])
    selector = np.concatenate([x[2] for x in steps])
    order = np.argsort(run, kind="stable")
    run, place, selector = run[order], place[order], selector[order]
    wide = np.zeros((runs, RUN + 64), U64)
    wide[:, :RUN] = grid
    words = selector.astype(U64) << U64(60)
    for k, (count, bits) in enumerate(PACKINGS):
        rows = np.flatnonzero(selector == k)
        for i in range(count if len(rows) else 0):
            words[rows] |= wide[run[rows], place[rows] + i] << U64(i * bits)
    over = np.flatnonzero(selector == ESCAPE)
    return words, np.bincount(run, minlength=runs).astype(np.uint32), grid[run[over], place[over]]


def decode(words: np.ndarray, run_words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n values again; every word knows its place from the words before it in its run."""
    selector = (words >> U64(60)).astype(np.int64)
    counts = COUNTS[selector]
    run = np.repeat(np.arange(len(run_words)), run_words)
    before = np.cumsum(counts) - counts
    first = np.cumsum(run_words.astype(np.int64)) - run_words
    place = before - before[first][run] + run * RUN
    end = np.minimum((run + 1) * RUN, n)
    out = np.zeros(n, U64)
    for k, (count, bits) in enumerate(PACKINGS):
        rows = np.flatnonzero(selector == k)
        for i in range(count if len(rows) else 0):
            inside = rows[place[rows] + i < end[rows]]
            out[place[inside] + i] = (words[inside] >> U64(i * bits)) & U64((1 << bits) - 1)
    out[place[selector == ESCAPE]] = escapes
    return out
