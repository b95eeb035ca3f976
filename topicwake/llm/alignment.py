"""Edit distances and alignments of many pairs of word sequences at once."""

from __future__ import annotations

import numpy as np

_FAR = np.int32(1 << 20)


def pad(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, fill: int, width: int | None = None) -> np.ndarray:
    """Rows of the given slices, filled up to one width."""
    width = int(lengths.max(initial=0)) if width is None else width
    place = np.arange(width)
    inside = place[None, :] < lengths[:, None]
    at = np.where(inside, starts[:, None] + place[None, :], 0)
    return np.where(inside, values[at] if len(values) else 0, np.uint64(fill))


def _rows(items: np.ndarray, texts: np.ndarray, first: np.ndarray):
    """Rows of the edit table, one for each word of ``items`` and the first: the cells of all pairs together.

    A step to the right costs 1, so the least over all cells to the left is a running minimum of the
    values less their place.
    """
    n, width = texts.shape
    place = np.arange(width + 1, dtype=np.int32)
    row = first
    yield row
    for i in range(items.shape[1]):
        step = row + 1
        np.minimum(step[:, 1:], row[:, :-1] + (items[:, i : i + 1] != texts), out=step[:, 1:])
        row = np.minimum.accumulate(step - place, axis=1) + place
        yield row


def find_within(items: np.ndarray, sizes: np.ndarray, texts: np.ndarray, text_sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(edits, start, end) of the place in each text row that is nearest to its item row.

    Items are padded with 0 and texts with 1 (no word hash is either). The first pass leaves the start
    open and finds the end, the second runs backward from there and finds the start; the first such
    places are taken.
    """
    n, width = texts.shape
    best, end = np.full(n, _FAR), np.zeros(n, np.int64)
    inside = np.arange(width + 1)[None, :] <= text_sizes[:, None]
    for i, row in enumerate(_rows(items, texts, np.zeros((n, width + 1), np.int32))):
        done = np.flatnonzero(sizes == i)
        if len(done):
            cells = np.where(inside[done], row[done], _FAR)
            end[done] = cells.argmin(axis=1)
            best[done] = cells.min(axis=1)
    back_items = np.zeros_like(items)
    back_texts = np.ones_like(texts)
    for k in range(n):
        back_items[k, : sizes[k]] = items[k, : sizes[k]][::-1]
        back_texts[k, : end[k]] = texts[k, : end[k]][::-1]
    start = end.copy()
    ahead = np.broadcast_to(np.arange(width + 1, dtype=np.int32), (n, width + 1)).copy()
    for i, row in enumerate(_rows(back_items, back_texts, ahead)):
        done = np.flatnonzero(sizes == i)
        if len(done):
            hit = (row[done] == best[done][:, None]) & (np.arange(width + 1)[None, :] <= end[done][:, None])
            start[done] = end[done] - hit.argmax(axis=1)
    return best, start, end


def edit_distances(left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray) -> np.ndarray:
    """Edit distance of whole rows; padding as in ``find_within``."""
    n, width = right.shape
    out = np.zeros(n, np.int64)
    first = np.broadcast_to(np.arange(width + 1, dtype=np.int32), (n, width + 1)).copy()
    for i, row in enumerate(_rows(left, right, first)):
        done = np.flatnonzero(left_sizes == i)
        out[done] = row[done, right_sizes[done]]
    return out


def best_prefixes(
    left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray, cost: int = 3
) -> tuple[np.ndarray, np.ndarray]:
    """(words of left, edits) of the prefixes of each pair that align best: words less ``cost`` times the edits is largest."""
    n, width = right.shape
    best, length, edits = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    inside = np.arange(width + 1)[None, :] <= right_sizes[:, None]
    first = np.broadcast_to(np.arange(width + 1, dtype=np.int32), (n, width + 1)).copy()
    for i, row in enumerate(_rows(left, right, first)):
        least = np.where(inside, row, _FAR).min(axis=1)
        value = i - cost * least.astype(np.int64)
        better = (value > best) & (i <= left_sizes)
        best[better], length[better], edits[better] = value[better], i, least[better]
    return length, edits
