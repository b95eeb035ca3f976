"""SuperMinHash signatures of many sets at once."""

from __future__ import annotations

import numpy as np

from topicwake.llm.text import U64, mix

_STEP = U64(0x9FB21C651E98DF25)
_LOW = U64(0xFFFFFFFF)


def signatures(sets: np.ndarray, hashes: np.ndarray, n: int, slots: int) -> np.ndarray:
    """n x slots values; row i is that of the hashes whose ``sets`` entry is i. Hashes are distinct in a set.

    Each element deals its ranks 0, 1, 2, ... to the slots in an order of its own (a Fisher-Yates shuffle
    drawn from its hash), with a random fraction behind the rank; a slot keeps its least value. Since an
    element gives each rank once, the slots of a set are less alike than independent ones. A set stops as
    soon as all its slots are below the next rank: nothing later could be less. Values are fixed point, rank
    in the upper 32 bits. Rows of empty sets are all ones.
    """
    best = np.full((n, slots), ~U64(0))
    flat = best.ravel()
    rows, element = sets, hashes
    order = np.zeros((0, slots), np.uint16)
    for rank in range(slots):
        if not len(rows):
            break
        if rank == 1:
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(rows), 1))
            at = np.arange(len(rows))
            order[at, 0], order[at, drawn] = order[at, drawn], 0  # noqa: F821 (the draw of rank 0, below)
        random = mix(element + U64((int(_STEP) * (rank + 1)) & (2**64 - 1)))
        drawn = (rank + (((random >> U64(32)) * U64(slots - rank)) >> U64(32))).astype(np.int64)
        if rank:
            at = np.arange(len(rows))
            slot = order[at, drawn]
            order[at, drawn] = order[at, rank]
            order[at, rank] = slot
            slot = slot.astype(np.int64)
        else:
            slot = drawn
        np.minimum.at(flat, rows * slots + slot, (U64(rank) << U64(32)) | (random & _LOW))
        present = np.zeros(n, bool)
        present[rows] = True
        open_sets = np.zeros(n, bool)
        live = np.flatnonzero(present)
        open_sets[live] = best[live].max(axis=1) >= (U64(rank + 1) << U64(32))
        keep = open_sets[rows]
        if not keep.all():
            rows, element, drawn = rows[keep], element[keep], drawn[keep]
            if rank:
                order = order[keep]
    return best


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    """n x bands hashes, each of one run of slots and its place."""
    n, slots = values.shape
    width = slots // bands
    parts = values[:, : bands * width].reshape(n, bands, width)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), (n, bands)).copy()
    for i in range(width):
        key = mix(key ^ parts[:, :, i])
    return key
