"""Byte-pair merges of many pre-tokens at once on ragged numpy arrays."""

from __future__ import annotations

import json

import numpy as np

from topicwake.llm.text import U64, mix

_NONE = np.iinfo(np.int32).max


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabulary files (a public convention)."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    names, spare = [], 256
    for b in range(256):
        names.append(chr(b if b in plain else spare))
        spare += b not in plain
    return names


class Merges:
    """Merge ranks of a byte-level vocabulary file in an open-addressed table of pairs.

    In each round every sequence applies its own lowest-rank pair, at all its places. That equals one
    merge at a time as long as no pair made of a merged symbol ranks before the pair that makes this
    symbol, which is checked here for every merge of the file.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        names = _byte_names()
        self.first = np.array([vocab[x] for x in names], np.int32)
        self.last = np.array([vocab[x + suffix] for x in names], np.int32)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.count = len(vocab)
        ranks = np.arange(len(pairs))
        made = np.full(max(vocab.values()) + 1, -1)
        made[self.result[::-1]] = ranks[::-1]
        if (made[left] >= ranks).any() or (made[right] >= ranks).any() or len(np.unique(self.result)) < len(ranks):
            raise ValueError("a pair ranks before the pair that makes one of its symbols")
        keys = (left.astype(U64) << U64(32)) | right.astype(U64)
        self.mask = (1 << 18) - 1
        self.keys, self.ranks = np.full(self.mask + 1, ~U64(0)), np.full(self.mask + 1, _NONE, np.int32)
        self.probes, todo = 0, np.arange(len(keys))
        while len(todo):
            at = self._slot(keys[todo], self.probes)
            slots, chosen = np.unique(at, return_index=True)
            free = self.keys[slots] == ~U64(0)
            placed = chosen[free]
            self.keys[slots[free]], self.ranks[slots[free]] = keys[todo[placed]], ranks[todo[placed]]
            todo = np.delete(todo, placed)
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((mix(keys) >> U64(20)) + U64(probe)).astype(np.int64) & self.mask

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(U64) << U64(32)) | right.astype(U64)
        out = np.full(len(keys), _NONE, np.int32)
        at = self._slot(keys, 0)
        todo = np.arange(len(keys))
        for _ in range(self.probes):
            seen = self.keys[at]
            hit = seen == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            more = ~hit & (seen != ~U64(0))
            if not more.any():
                break
            todo, at = todo[more], (at[more] + 1) & self.mask
        return out

    def apply(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all sequences, number of ids of each) for byte sequences that follow one another.

        Lengths are 1 or more. Sequences without a pair left to merge are set aside after each round, so
        late rounds touch the few long ones only.
        """
        symbols = self.first[data]
        symbols[np.cumsum(lengths) - 1] = self.last[data[np.cumsum(lengths) - 1]]
        n = len(lengths)
        done_ids, done_seq = [], []
        seq = np.repeat(np.arange(n), lengths)
        ranks = np.full(len(symbols), _NONE, np.int32)
        inner = np.flatnonzero(seq[:-1] == seq[1:])
        ranks[inner] = self.rank_of(symbols[inner], symbols[inner + 1])
        while len(seq):
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            sizes = np.diff(np.append(starts, len(seq)))
            best = np.minimum.reduceat(ranks, starts)
            still = np.repeat(best < _NONE, sizes)
            done_ids.append(symbols[~still])
            done_seq.append(seq[~still])
            hit = (ranks == np.repeat(best, sizes)) & still
            symbols, seq, ranks, hit = symbols[still], seq[still], ranks[still], hit[still]
            at = np.flatnonzero(hit)
            if not len(at):
                break
            twin = np.flatnonzero(np.append(False, np.diff(at) == 1))
            if len(twin):  # of equal symbols in a row, every other place from the left
                run = np.flatnonzero(np.append(True, np.diff(at) != 1))
                place = at - np.repeat(at[run], np.diff(np.append(run, len(at))))
                at = at[place % 2 == 0]
            symbols[at] = self.result[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            fresh = np.zeros(len(symbols), bool)
            fresh[at] = True
            symbols, seq, ranks, fresh = symbols[keep], seq[keep], ranks[keep], fresh[keep]
            changed = fresh.copy()
            changed[:-1] |= fresh[1:]
            at = np.flatnonzero(changed)
            ranks[at] = _NONE
            at = at[at + 1 < len(seq)]
            at = at[seq[at] == seq[at + 1]]
            ranks[at] = self.rank_of(symbols[at], symbols[at + 1])
        ids, owner = np.concatenate(done_ids), np.concatenate(done_seq)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=n)
