"""Sparse indicator features of texts: hashed words, word pairs, byte runs and coarse shapes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwake.llm.jobs import Batches, map_arrow
from topicwake.llm.text import LOWER, PUNCT, SPACE, U64, Words, blocks, grams, mix, rolling

#: (data, offsets) of a block -> (text, hash) of each indicator, repeats allowed.
View = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _texts(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words without punctuation."""
    w = Words(data, offsets, PUNCT)
    return _texts(w.bounds), mix(w.hash + U64(1))


def stems(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 4 and the first 5 bytes of longer lower-cased words."""
    w = Words(data, offsets, PUNCT)
    text, roll = _texts(w.bounds), rolling(LOWER[data])
    out = []
    for n in (4, 5):
        long = w.end - w.start > n
        out.append((text[long], mix(roll.of(w.start[long], w.start[long] + n) + U64(4))))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def word_pairs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = Words(data, offsets, PUNCT)
    text = _texts(w.bounds)
    same = text[:-1] == text[1:]
    return text[:-1][same], mix(grams(w.hash, 2) + U64(2))[same]


def byte_runs(data: np.ndarray, offsets: np.ndarray, n: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Every n bytes of a text, case and punctuation kept."""
    if len(data) < n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    start = np.arange(len(data) - n + 1)
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start + n <= offsets[text + 1]
    return text[inside], mix(rolling(data).of(start[inside], start[inside] + n) + U64(3))


def shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of some signs and of repeated words in a text, each in one of 16 steps."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    share = []
    upper = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    for hit in (upper, digit, PUNCT[data] & ~SPACE[data], data == 10, SPACE[data], data >= 128):
        sums = np.append(0, np.cumsum(hit))
        share.append(np.diff(sums[offsets]) / size)
    w = Words(data, offsets)
    text, count = _texts(w.bounds), np.maximum(w.counts, 1)
    for back in (1, 2):
        again = np.zeros(len(w), bool)
        again[back:] = (w.hash[back:] == w.hash[:-back]) & (text[back:] == text[:-back])
        share.append(np.bincount(text[again], minlength=n) / count)
    order = np.lexsort((w.hash, text))
    h, t = w.hash[order], text[order]
    fresh = np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]))[: len(h)]
    share.append(np.bincount(t[fresh], minlength=n) / count)
    share.append(np.minimum(np.log2(count + 1) / 16, 1))
    step = np.minimum(np.sqrt(np.stack(share)) * 16, 15).astype(U64)
    key = step + (np.arange(len(share), dtype=U64) * U64(16))[:, None]
    return np.tile(np.arange(n), len(share)), mix(key.ravel() + U64(1 << 40))


def rows(data: np.ndarray, offsets: np.ndarray, views: tuple[View, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, indices): distinct hashed indicators of each text of a block."""
    parts = [view(data, offsets) for view in views]
    text = np.concatenate([p[0] for p in parts]).astype(U64)
    index = np.concatenate([p[1] for p in parts]) >> U64(64 - bits)
    pairs = np.unique((text << U64(bits)) | index)
    return np.searchsorted(pairs, np.arange(len(offsets), dtype=U64) << U64(bits)), (pairs & U64((1 << bits) - 1)).astype(np.int64)


def sums(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of each row's values; 0 for a row without any."""
    return np.diff(np.append(0.0, np.cumsum(values))[bounds])


def collect_rows(df: DataFrame, views: tuple[View, ...], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, bounds, indices) of a bounded sample ``df`` (label, text) on the driver, in a fixed order."""

    def featurize(batches: Batches) -> Batches:
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(2)):
                bounds, index = rows(data, offsets, views, bits)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(index, pa.int32()))
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), lists],
                    names=["id", "label", "features"],
                )

    table = map_arrow(df.select("id", "label", "text"), featurize, "id long, label int, features array<int>").toArrow()
    order = np.lexsort((np.asarray(table.column("label")), np.asarray(table.column("id"))))
    table = table.take(pa.array(order)).combine_chunks()
    lists = table.column("features").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    labels = np.asarray(table.column("label").combine_chunks()).astype(np.int8)  # narrow types: the driver holds all of them
    return labels, np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py(), np.asarray(lists.flatten())


def score_texts(
    df: DataFrame, views: tuple[View, ...], bits: int, weights: np.ndarray, norm: bool, bias: float, slope: float = 1.0
) -> DataFrame:
    """(id, score) of each row of ``df`` (id, text): the logistic of a linear function of its indicators."""
    held = df.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # 2^bits weights, whatever the data

    def score(batches: Batches) -> Batches:
        w = held.value
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                bounds, index = rows(data, offsets, views, bits)
                total = sums(bounds, w[index].astype(float))
                if norm:
                    total /= np.sqrt(np.maximum(np.diff(bounds), 1))
                value = 1 / (1 + np.exp(-np.clip(slope * total + bias, -30, 30)))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(value)], names=["id", "score"])

    return map_arrow(df.select("id", "text"), score, "id long, score double")


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def bounded_sample(df: DataFrame, id_col: str, limit: int, salt: int = 0) -> DataFrame:
    """At most ``limit`` rows, the same ones on every run: those whose ids hash least."""
    order = F.xxhash64(F.col(id_col), F.lit(salt))
    return df.orderBy(order, id_col).limit(limit)
