"""Running Python functions on Arrow batches, with this package at hand on every executor."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import sys
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import topicwake

Batches = Iterator[pa.RecordBatch]

#: Rows of a batch handed to Python, unless the session asks for another number than Spark's own.
BATCH_ROWS = 2_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once for each application.

    The functions keep caches of their own modules (vocabularies, power tables) from task to task, so the
    modules must be importable there. Spark serves the archive from the driver. Rows are whole texts, so
    batches of Spark's default of 10,000 rows are made smaller; both sides of the pipe hold a few of them.
    """
    if spark.conf.get(_ROWS) == "10000":
        spark.conf.set(_ROWS, BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_topicwake_shipped", False):
        return
    root = Path(topicwake.__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/topicwake", "zip", root.parent, root.name)
    context.addPyFile(archive)
    context._topicwake_shipped = True


def _release() -> None:
    """Give freed memory back to the system; a worker waits for its next task, beside others that need it. Powers are soon made again."""
    if module := sys.modules.get("topicwake.llm.text"):
        module._powers.cache_clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def _forget_tokenizers() -> None:
    """Give up the tokenizers that earlier tasks of this Python process left, up to 150 MB each."""
    for name, cached in (("topicwake.llm.encode", "encoder"), ("topicwake.llm.token_counts", "counter")):
        if module := sys.modules.get(name):
            getattr(module, cached).cache_clear()


def map_arrow(df: DataFrame, function: Callable[[Batches], Batches], schema: str, tokenizer: bool = False) -> DataFrame:
    """``df.mapInArrow`` with this package at hand. A process keeps its tokenizer from task to task while tasks ask for one by ``tokenizer``."""
    ship(df.sparkSession)

    def run(batches: Batches) -> Batches:
        if not tokenizer:
            _forget_tokenizers()
        yield from function(batches)
        _release()

    return df.mapInArrow(run, schema)
