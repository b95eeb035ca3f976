"""Token ids in binary files, packed with Simple-8b.

A file holds whole documents in ascending order of their ids:

    block*   header 5 x uint32: documents, values, runs, words, escapes
             document ids int64, null marks uint8, values of each document uint32,
             words of each run uint32, words uint64, escapes uint64
    footer   place of each block uint64, number of blocks uint64, magic 8 bytes

Runs of 1,024 values begin at a word of their own, so a reader decodes all runs of a block at once.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicwake.llm.encode import encoder
from topicwake.llm.simple8b import decode, encode
from topicwake.llm.jobs import map_arrow
from topicwake.session import materialize

MAGIC = b"TWIDS\x00\x00\x01"


def pack_block(doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, run_words, escapes = encode(ids.astype(np.uint64))
    head = np.array([len(counts), len(ids), len(run_words), len(words), len(escapes)], "<u4")
    keys = np.asarray(doc_ids.fill_null(0).cast(pa.int64()))
    nulls = np.asarray(doc_ids.is_null().cast(pa.uint8()))
    parts = [head, keys.astype("<i8"), nulls, counts.astype("<u4"), run_words.astype("<u4"), words.astype("<u8"), escapes.astype("<u8")]
    return b"".join(x.tobytes() for x in parts)


def unpack_block(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(document ids, values of each document, values)."""
    docs, n, runs, n_words, n_escapes = np.frombuffer(data, "<u4", 5).tolist()
    at, parts = 20, []
    for kind, size in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u4", runs), ("<u8", n_words), ("<u8", n_escapes)):
        parts.append(np.frombuffer(data, kind, size, at))
        at += parts[-1].nbytes
    keys, nulls, counts, run_words, words, escapes = parts
    return pa.array(keys, mask=nulls.astype(bool)), counts.astype(np.int64), decode(words, run_words, escapes, n)


def read_blocks(path: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Blocks of a file one at a time."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as f:
        size = f.size()
        tail = f.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path} is no token file")
        n = int(np.frombuffer(tail, "<u8", 1)[0])
        places = np.frombuffer(f.read_at(8 * n, size - 16 - 8 * n), "<u8").tolist() + [size - 16 - 8 * n]
        for a, b in zip(places, places[1:]):
            yield unpack_block(f.read_at(b - a, a))


def write_token_files(
    df: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str,
    words_only: bool = True,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the ids of all texts below ``folder``; returns (part, path, n_docs, n_ids, start), a row a file.

    Files follow one another in ascending document id, equal ids in any order, null ids first. Every text
    ends with ``end_id``; a null or empty one is that id alone. ``start`` counts the ids of the files
    before. A task writes under a name of its own and renames at the end, so that a lost executor
    leaves nothing behind that a reader sees. An empty table gives no files. Other columns are ignored.
    """
    spark = df.sparkSession
    files = files or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out, store = encoder(tokenizer, words_only), None, None
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        places, at, n_docs, n_ids = [], 0, 0, 0
        path = f"{folder}/part-{part:06d}.ids"
        for batch in batches:
            for lo, ids, offsets in own.blocks(batch.column(1)):
                if out is None:
                    store, name = fs.FileSystem.from_uri(path)
                    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(f"{name}.{attempt}")
                ends = np.full(len(ids) + len(offsets) - 1, end_id, np.uint64)
                keep = np.ones(len(ends), bool)
                keep[offsets[1:] + np.arange(len(offsets) - 1)] = False
                ends[keep] = ids
                data = pack_block(batch.column(0).slice(lo, len(offsets) - 1), np.diff(offsets) + 1, ends)
                out.write(data)
                places.append(at)
                at, n_docs, n_ids = at + len(data), n_docs + len(offsets) - 1, n_ids + len(ends)
        if out is not None:
            out.write(np.array([*places, len(places)], "<u8").tobytes() + MAGIC)
            out.close()
            store.move(f"{name}.{attempt}", name)
            yield pa.record_batch(
                [pa.array([part]), pa.array([path]), pa.array([n_docs]), pa.array([n_ids])], names=["part", "path", "n_docs", "n_ids"]
            )

    placed = rows.repartitionByRange(files, "id").sortWithinPartitions("id")
    manifest = materialize(map_arrow(placed, write, "part long, path string, n_docs long, n_ids long", tokenizer=True), "token-files")
    # one row a file, and two levels of sums, so that no window meets more than a few thousand of them
    block = manifest.withColumn("block", F.shiftright("part", 12))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    total = block.groupBy("block").agg(F.sum("n_ids").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(before.orderBy("block")), F.lit(0)).alias("base")
    )
    inside = F.coalesce(F.sum("n_ids").over(before.partitionBy("block").orderBy("part")), F.lit(0))
    return block.join(total, "block").select("part", "path", "n_docs", "n_ids", (F.col("base") + inside).alias("start"))


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files the manifest names."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for keys, counts, ids in read_blocks(path):
                    raw = ids.astype("<u4").tobytes()
                    ends = np.cumsum(counts)
                    sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                    yield pa.record_batch(
                        [keys, pa.array(start + ends - counts), pa.array(counts), pa.array(sums, pa.int64())],
                        names=[id_col, "start", "n_tokens", "ids_crc32"],
                    )
                    start += int(counts.sum())

    spread = manifest.select("path", "start").repartition(
        max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path"
    )
    return map_arrow(spread, read, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")

