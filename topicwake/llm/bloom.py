"""A filter of fixed size on long keys that lets all wanted keys through, and few others while it is not full."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwake.llm.jobs import Batches, map_arrow
from topicwake.llm.text import U64, mix

_BITS, _PARTS = 1 << 24, 8


def _places(keys: np.ndarray) -> list[np.ndarray]:
    h = mix(keys.astype(np.int64).view(U64) + U64(1))
    return [((h >> U64(i)) & U64(_BITS - 1)).astype(np.int64) for i in (0, 13, 26, 39)]


class KeyFilter:
    """True for every key it was made from; ``test`` works on arrays inside tasks, ``column`` on a long column."""

    def __init__(self, held):
        self.held = held

    def test(self, keys: np.ndarray) -> np.ndarray:
        table, hit = self.held.value, np.ones(len(keys), bool)
        for place in _places(keys):
            hit &= (table[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        return hit

    def column(self, name: str) -> Column:
        test = self.test

        @F.arrow_udf("boolean")
        def check(keys: pa.Array) -> pa.Array:
            return pa.array(test(np.asarray(keys)))

        return check(F.coalesce(F.col(name), F.lit(0).cast("long")))


def key_filter(keys: DataFrame) -> KeyFilter:
    """A filter for the one long column of ``keys``, without nulls.

    It saves moving rows that a join would drop. Every task marks its keys in a table of two megabytes, 8 tasks lay these
    over each other, and the driver gets 8 tables however many keys there are. Beyond some tens of millions of
    keys the filter lets more through, and a join behind it still gives exact results.
    """

    def packed(bits: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    def build(batches: Batches) -> Batches:
        bits = None
        for batch in batches:
            if bits is None:
                bits = np.zeros(_BITS, bool)
            for place in _places(np.asarray(batch.column(0))):
                bits[place] = True
        if bits is not None:
            yield packed(np.packbits(bits))

    def merge(batches: Batches) -> Batches:
        bits = np.zeros(_BITS // 8, np.uint8)
        for batch in batches:
            for x in batch.column(0):
                bits |= np.frombuffer(x.as_buffer(), np.uint8)
        yield packed(bits)

    marked = map_arrow(keys, build, "bits binary").repartition(_PARTS)
    bits = np.zeros(_BITS // 8, np.uint8)
    for row in map_arrow(marked, merge, "bits binary").toLocalIterator():
        bits |= np.frombuffer(row["bits"], np.uint8)
    return KeyFilter(keys.sparkSession.sparkContext.broadcast(bits))


def without(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """Rows of ``df`` whose key is not in the one column of ``keys``; null keys stay. Only doubtful rows are exchanged."""
    keys = keys.toDF(col).where(F.col(col).isNotNull()).distinct()
    listed = key_filter(keys)
    doubtful = df.where(listed.column(col)).join(keys, col, "left_anti")
    return df.where(~listed.column(col)).unionByName(doubtful)
