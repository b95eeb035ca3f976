"""Token counts of texts by rank-synchronous merging of pre-tokens held in arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwake.llm.jobs import map_arrow
from topicwake.llm.merges import Merges
from topicwake.llm.pretokens import IdCache, Split, Tables
from topicwake.llm.text import blocks

#: Fixed value: the public pattern of pre-tokens that tile a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Counter:
    """Numbers of tokens by a byte-level tokenizer file whose pre-tokens follow ``PATTERN``."""

    def __init__(self, path: str):
        import json

        import regex

        self.merges, self.tables, self.pattern = Merges(path), Tables(words_only=False), regex.compile(PATTERN)
        with open(path, encoding="utf-8") as f:
            self.specials = tuple(x["content"] for x in json.load(f).get("added_tokens", []))
        self.cache = IdCache(self.merges.apply)

    def _rare(self, text: str) -> int:
        """A text with rare characters or special strings; each such string is one token."""
        parts, special = [text], 0
        for x in self.specials:
            cut = [part.split(x) for part in parts]
            special += sum(len(c) - 1 for c in cut)
            parts = [part for c in cut for part in c]
        raw = [x.encode() for part in parts for x in self.pattern.findall(part)]
        if not raw:
            return special
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        return special + len(self.merges.apply(np.frombuffer(b"".join(raw), np.uint8), sizes)[0])

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, tokens) of each text; null counts as empty."""
        sizes, tokens = [], []
        for _, _, data, offsets in blocks(texts):
            split = Split(data, offsets, self.tables, tuple(x.encode() for x in self.specials))
            rows = self.cache.places(split)
            before = np.append(0, np.cumsum(self.cache.lengths[rows], dtype=np.int64))
            found = np.diff(before[split.bounds])
            for i in np.flatnonzero(split.slow):
                found[i] = self._rare(data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8"))
            sizes.append(np.diff(offsets))
            tokens.append(found)
        join = lambda xs: np.concatenate(xs).astype(np.int64) if xs else np.zeros(0, np.int64)
        return join(sizes), join(tokens)


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(
    df: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row (id, n_bytes, n_tokens, over_limit) for each row of ``df``, repeated rows included.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null. Texts are read whole; other
    columns are ignored. One pass over the scan, nothing is exchanged.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            sizes, tokens = own.counts(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(sizes), pa.array(tokens)], names=[id_col, "n_bytes", "n_tokens"])

    rows = df.select(id_col, text_col)
    schema = f"`{id_col}` {rows.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long"
    return map_arrow(rows, count, schema, tokenizer=True).withColumn("over_limit", F.col("n_tokens") > limit)
