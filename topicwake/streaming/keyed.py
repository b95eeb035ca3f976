"""Count windows for each key of a stream, in Spark's own state store."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from topicwake.operators.drift import _SMOOTH, judge_windows

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Shares of the keys that have a state of their own, and so the calls of Python a micro-batch at most.
_SHARES = 1024


class KeyedWindows(StatefulProcessor):
    """The finished windows of a share of the keys, each with its topic shares and those of the window before it.

    The state holds for each key the number of its rows with a topic, the tallies of its open window and the shares of its last finished one,
    NaN if there is none; all but the keys as the bytes of numbers, 8 each. A key's rows count in id order within a micro-batch; of these it holds key, id and topic, while windows are cut, and nothing afterwards.
    """

    def __init__(self, window: int, k: int, key_type: T.DataType):
        self.window, self.k = window, k
        self.kept = T.StructType().add("keys", T.ArrayType(key_type)).add("rows", "binary").add("counts", "binary").add("previous", "binary")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.carry = handle.getValueState("carry", self.kept)

    def handleInputRows(self, share: Any, rows: Iterator[pd.DataFrame], timer_values: Any) -> Iterator[pd.DataFrame]:
        window, k = self.window, self.k
        batch = pd.concat([part[["key", "id", "topic"]] for part in rows], ignore_index=True)
        seen = self.carry.get() or ([], b"", b"", b"")
        known = len(seen[0])
        if share[0] < 0:  # the null key alone
            codes, names = np.zeros(known + len(batch), np.int64), pd.Index([None], dtype=object)
        else:
            keys = pd.concat([pd.Series(seen[0], dtype=batch["key"].dtype), batch["key"]], ignore_index=True)
            codes, names = pd.factorize(keys, use_na_sentinel=False)  # the known ones first, in their order
        start, counts, previous = np.zeros(len(names), np.int64), np.zeros((len(names), k), np.int64), np.full((len(names), k), np.nan)
        start[:known] = np.frombuffer(seen[1], "<i8")
        counts[:known], previous[:known] = (np.frombuffer(x, kind).reshape(known, k) for x, kind in ((seen[2], "<i8"), (seen[3], "<f8")))

        key, ids, topics = codes[known:], batch["id"].to_numpy(np.int64), batch["topic"].to_numpy(np.int64)
        order = np.lexsort((ids, key))
        key, ids, topics = key[order], ids[order], topics[order]
        heads = np.append(True, key[1:] != key[:-1])
        number = start[key] + np.arange(len(key)) - np.flatnonzero(heads)[np.cumsum(heads) - 1]
        opens = heads | (number % window == 0)  # a row a window of a key, finished or not
        first, last = np.flatnonzero(opens), np.append(np.flatnonzero(opens)[1:], len(key)) - 1
        tally = np.bincount((np.cumsum(opens) - 1) * k + topics, minlength=len(first) * k).reshape(-1, k)
        owner, new = key[first], heads[first]
        tally[new] += counts[owner[new]]
        done = number[last] % window == window - 1
        dist = (tally + _SMOOTH) / (window + k * _SMOOTH)
        before = np.where(new[:, None], previous[owner], np.roll(dist, 1, axis=0))

        ends = np.append(new[1:], True)
        start[owner[ends]] = number[last[ends]] + 1
        counts[owner[ends]] = np.where(done[ends, None], 0, tally[ends])
        previous[owner[done]] = dist[done]  # the last of a key's windows stays
        self.carry.update((list(names), start.tobytes(), counts.tobytes(), previous.tobytes()))
        if done.any():
            columns = {"key": names[owner[done]], "window_id": number[first[done]] // window, "closing_id": ids[last[done]], "dist": dist[done].tolist()}
            yield pd.DataFrame(columns | {"previous_dist": [None if x[0] != x[0] else x for x in before[done].tolist()]})

    def close(self) -> None:
        pass


def keyed_drift(scored: DataFrame, key_col: str, window: int, k: int, threshold: float) -> DataFrame:
    """(key, window_id, closing_id, js_divergence, drift_detected, drift_magnitude) of a stream (key, id, dominant_topic).

    Every key has windows of its own, numbered from 0. Rows without a topic do not count. A null key is a key like any other. Only
    key, id and topic are exchanged. A row that comes in a later micro-batch than rows of greater ids counts where it comes. Keys share
    states, dealt by their hash, since each state costs a few milliseconds a micro-batch; a micro-batch writes the states of its keys' shares anew.
    """
    spark = scored.sparkSession
    if spark.conf.get(_PROVIDER, None) != _ROCKS:
        spark.conf.set(_PROVIDER, _ROCKS)  # the only store that holds this kind of state
    key, topic = F.col(key_col), F.col("dominant_topic").cast("long").alias("topic")
    share = F.when(key.isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(_SHARES)))  # null keys have a share of their own
    if isinstance(scored.schema[key_col].dataType, T.NumericType):  # pandas makes floats of whole numbers that stand with a null
        key = F.coalesce(key, F.lit(0).cast(scored.schema[key_col].dataType))
    rows = scored.select(share.alias("share"), key.alias("key"), "id", topic).where(F.col("topic").between(0, k - 1) & F.col("id").isNotNull())
    shares = T.ArrayType(T.DoubleType())
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("window_id", T.LongType()), T.StructField("closing_id", T.LongType())])
    schema = schema.add("dist", shares).add("previous_dist", shares)
    processor = KeyedWindows(window, k, rows.schema["key"].dataType)
    windows = rows.groupBy("share").transformWithStateInPandas(processor, schema, "Append", "None")
    return judge_windows(windows, threshold, keys=("key",)).withColumnRenamed("key", key_col)
