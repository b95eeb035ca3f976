"""Importance resampling towards a target distribution of hashed word n-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwake.llm.jobs import Batches, map_arrow
from topicwake.llm.text import blocks
from topicwake.operators.ids import dense_id
from topicwake.session import discard, materialize

#: The bytes of words once A-Z are lower case, and the sentinel between texts, which is none of them.
WORD, BETWEEN = re.compile(rb"([0-9a-z\x80-\xff]+)"), b"\0"
_NOT_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Bytes of joined texts that one regular expression pass takes.
PIECE = 1 << 20
_POLYNOMIAL, _DIRECT = 0xEDB88320, 256


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(_POLYNOMIAL), x >> 1)
    return x


class Shift:
    """What a crc32 becomes when n bytes follow, apart from these bytes' own crc32: crc(a + b) = shift(crc(a), len(b)) ^ crc(b).

    The map is linear over bits, so it is the xor of one entry for each of the four bytes. There is a table for each n below 256; longer
    stretches go by tables of 256, 512, 1,024, ... bytes.
    """

    def __init__(self) -> None:
        one = _byte_table()
        table = [(np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32))]
        for _ in range(_DIRECT):
            table.append(one[table[-1] & 0xFF] ^ (table[-1] >> 8))
        self.direct = np.stack(table[:_DIRECT])
        self.longer = [table[_DIRECT]]

    @staticmethod
    def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 0xFF] ^ table[1][(crc >> 8) & 0xFF] ^ table[2][(crc >> 16) & 0xFF] ^ table[3][crc >> 24]

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        low, d = n & (_DIRECT - 1), self.direct
        out = d[low, 0, crc & 0xFF] ^ d[low, 1, (crc >> 8) & 0xFF] ^ d[low, 2, (crc >> 16) & 0xFF] ^ d[low, 3, crc >> 24]
        rest, k = n // _DIRECT, 0
        while rest.any():
            if k == len(self.longer):
                self.longer.append(self._through(self.longer[-1], self.longer[-1]))
            odd = np.flatnonzero(rest & 1)
            out[odd] = self._through(self.longer[k], out[odd])
            rest, k = rest >> 1, k + 1
        return out


_shift = Shift()
_SPACE = np.uint32(zlib.crc32(b" "))


def _words(joined: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, length, crc32) of the words, piece by piece; a piece ends where no word does, however long that word is."""
    at = 0
    while at < len(joined):
        end = at + PIECE
        cut = _NOT_WORD.search(joined, end) if end < len(joined) else None
        end = cut.start() if cut else len(joined)
        parts = WORD.split(joined[at:end])  # what is between and the words, in turn
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(sizes)
        words = parts[1::2]
        yield at + ends[0:-1:2], sizes[1::2], np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        at = end


def features(data: np.ndarray, offsets: np.ndarray, n: int = 3) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, crc32) of the runs of 1 to ``n`` words in a block of texts, and the texts of the piece's words, piece by piece.

    The texts are joined with a sentinel between them, one pass of a regular expression finds all words, and each word's text is searched in
    the texts' offsets; runs that cross texts are masked out. The last n - 1 words of a piece go over to the next.
    """
    raw = data.tobytes()
    cuts = offsets.tolist()
    joined = BETWEEN.join(raw[a:b] for a, b in zip(cuts, cuts[1:])).lower()  # of bytes: A-Z only
    starts = offsets[:-1] + np.arange(len(offsets) - 1)
    text, size, crc = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    for place, length, own in _words(joined):
        old = len(text)
        fresh = np.searchsorted(starts, place, "right") - 1
        text, size, crc = np.append(text, fresh), np.append(size, length), np.append(crc, own)
        last = _shift(np.broadcast_to(_SPACE, len(size)), size) ^ crc  # of a space and the word
        out = [(text[old:], crc[old:])]
        run = crc
        for k in range(1, n):
            run = _shift(run[:-1], size[k:] + 1) ^ last[k:] if len(run) else run
            same = (text[: len(run)] == text[k:]) & (np.arange(len(run)) + k >= old)
            out.append((text[k:][same], run[same]))
        yield np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]), fresh
        keep = max(0, len(text) - (n - 1))
        text, size, crc = text[keep:], size[keep:], crc[keep:]


def bucket_counts(df: DataFrame, text_col: str, n: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one row a bucket at most."""

    def count(batches: Batches) -> Batches:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0)):
                for _, crc, _ in features(data, offsets, n):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    counted = map_arrow(df.select(F.col(f"`{text_col}`").alias("text")), count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of each bucket's share of the target over its share of the source), each with one feature more."""
    s, t, b = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def weigh(df: DataFrame, gain: np.ndarray, n: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight) of each row."""
    held = df.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def score(batches: Batches) -> Batches:
        gain = held.value
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1)):
                words, runs, weight = (np.zeros(hi - lo, np.int64) for _ in range(3))
                for text, crc, fresh in features(data, offsets, n):
                    words += np.bincount(fresh, minlength=hi - lo)
                    runs += np.bincount(text, minlength=hi - lo)
                    own = np.bincount(text, gain[crc % np.uint32(len(gain))], hi - lo)  # whole numbers below 2^53
                    weight += own.astype(np.int64)
                columns = [batch.column(0).slice(lo, hi - lo), *map(pa.array, (words, runs, weight))]
                yield pa.record_batch(columns, names=["id", "n_words", "n_features", "weight"])

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, score, "id long, n_words long, n_features long, weight long")


def importance_resample(
    df: DataFrame,
    target: DataFrame,
    percent: int = 5,
    min_words: int = 20,
    n: int = 3,
    buckets: int = 10_000,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of each row of ``df``; ``rank`` is null where the row is not drawn.

    Features are all runs of 1 to ``n`` words, hashed by crc32 into ``buckets``. A row's weight is the sum of the gains of its features'
    buckets, its score the weight and a Gumbel number drawn from the hash of ``seed`` and id: the ``percent`` of the rows of ``min_words`` or more that
    score highest are a sample without replacement in proportion to exp(weight / 1000). Ties go to the smaller id.

    A null text counts as empty; without words a row has no features and weight 0. A null id draws by the empty text and comes first
    among ties. Rows repeated whole count each, and are drawn one by one in any order. An empty target makes all target
    shares equal; an empty ``df`` gives no rows. Other columns are ignored.

    Both passes over the texts run where they are read; between them the driver holds two numbers a bucket. Only scores,
    five numbers a row, are exchanged, by ranges of the score.
    """
    gain = gains(bucket_counts(df, text_col, n, buckets), bucket_counts(target, text_col, n, buckets))
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(drawn, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weigh(df, gain, n, id_col, text_col).withColumn("score", F.col("weight") + gumbel)
    scored = scored.withColumns({"short": F.col("n_words") < min_words, "below": -F.col("score"), "tie": F.monotonically_increasing_id()})
    scored = materialize(scored, "scored")
    eligible = scored.where("not short").count()
    placed = dense_id(scored, ["short", "below", "id", "tie"], "place")
    discard(scored)
    rank = F.when(F.col("place") < percent * eligible // 100, F.col("place") + 1)
    return placed.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", rank.alias("rank"))
