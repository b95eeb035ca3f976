"""Ids of whole texts by a public tokenizer file, the same as its library gives them."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from topicwake.llm.merges import Merges
from topicwake.llm.pretokens import IdCache, Split, Tables
from topicwake.llm.text import blocks


class Encoder:
    """Encodes Arrow columns of texts block by block.

    ``words_only`` tells the pre-token rule of the file: lower-cased words without white space, or pieces
    that tile the text. Distinct pre-tokens are merged with the file's own merges; whole texts with rare
    characters or with the string of a special token go through the library. Both give the library's ids.
    """

    def __init__(self, path: str, words_only: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        self.specials = tuple(token.content.encode() for token in added)
        self.tables = Tables(words_only)
        self.cache = IdCache(Merges(path).apply)

    def _encode(self, strings: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(strings, add_special_tokens=False)]

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids of the block, offsets of its texts in them)."""
        for lo, hi, data, offsets in blocks(texts):
            split = Split(data, offsets, self.tables, self.specials)
            ids, counts = self.cache.ids_of(split)
            slow = np.flatnonzero(split.slow)
            if len(slow):
                begin = np.cumsum(counts) - counts
                parts = np.split(ids, begin[1:])
                strings = [data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8") for i in slow]
                for i, found in zip(slow, self._encode(strings)):
                    parts[i], counts[i] = np.array(found, np.uint32), len(found)
                ids = np.concatenate(parts).astype(np.uint32)
            yield lo, ids, np.append(0, np.cumsum(counts))


@lru_cache(maxsize=2)
def encoder(path: str, words_only: bool) -> Encoder:
    """One encoder in each Python process, its cache kept from task to task."""
    return Encoder(path, words_only)
