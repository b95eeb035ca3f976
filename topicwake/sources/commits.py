"""Several tables written as one: versions that a record, written last, makes visible.

    <path>/<TABLE>/version=<v>/...     files of one write, seen by nobody yet
    <path>/COMMITS/...                 a row a commit: batch, sequence, version, rows of each table

A batch is replaced by a later commit of the same batch. A reader takes the latest commit of each batch and joins its versions, so it sees all
tables of a batch before or all after a write, whenever that breaks off.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicwake.session import materialize
from topicwake.sources.stores import remove_folder

COMMITS = "COMMITS"
_RECORD = "batch string, sequence long, version string, committed timestamp, tables map<string, long>"
#: Commits after which their records are put together in one file.
_MANY = 200

Write = Callable[[str], None]


def _below(path: str, *parts: str) -> str:
    return "/".join([path.rstrip("/"), *parts])


def commit_log(spark: SparkSession, path: str) -> DataFrame:
    """Every commit recorded below ``path``; none if nothing has been committed yet."""
    try:
        return spark.read.schema(_RECORD).json(_below(path, COMMITS))
    except AnalysisException:
        return spark.createDataFrame([], _RECORD)


def live_commits(spark: SparkSession, path: str) -> DataFrame:
    """The latest commit of each batch: (batch, sequence, version, committed, tables)."""
    row = F.struct("sequence", "version", "committed", "tables")
    latest = F.max_by(row, F.struct("sequence", "version")).alias("r")
    return commit_log(spark, path).groupBy("batch").agg(latest).select("batch", "r.*")


def commit_tables(spark: SparkSession, path: str, tables: dict[str, Write], batch: str = "") -> str:
    """Write all ``tables`` as one version of ``batch``, and record it when the last one is complete; returns the version.

    Each function writes its table to the folder it is given. What a failed call leaves is never read, and :func:`vacuum` removes it. One
    writer at a time may write a batch; the later of two commits replaces the earlier.
    """
    version, counts = uuid.uuid4().hex, {}
    for name, write in tables.items():
        folder = _below(path, name, f"version={version}")
        write(folder)
        counts[name] = spark.read.format("binaryFile").load(folder).count()
    last = commit_log(spark, path).agg(F.max("sequence")).first()[0] or 0
    row = spark.createDataFrame([(batch, last + 1, version, counts)], "batch string, sequence long, version string, tables map<string, long>")
    record = row.withColumn("committed", F.current_timestamp()).select("batch", "sequence", "version", "committed", "tables")
    record.coalesce(1).write.mode("append").json(_below(path, COMMITS))
    if (last + 1) % _MANY == 0:
        compact_commits(spark, path)
    return version


def read_committed(spark: SparkSession, path: str, name: str, schema: T.StructType, fmt: str = "parquet", with_batch: bool = False) -> DataFrame:
    """The rows of a table in the latest commit of each batch; only the folders of these versions are read.

    The comparison tells Spark that the few commits select among the folders, which it then prunes at run time.
    """
    live = live_commits(spark, path).where((F.col("sequence") > 0) & (F.col("tables")[name] >= 0))
    live = live.select("version", F.col("batch").alias("_batch"))
    held = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    try:
        rows = spark.read.schema(held).format(fmt).load(_below(path, name))
    except AnalysisException:
        rows = spark.createDataFrame([], held)
    rows = rows.join(live, "version")
    columns = schema.fieldNames()
    return rows.select(*columns, F.col("_batch").alias("batch")) if with_batch else rows.select(*columns)


def compact_commits(spark: SparkSession, path: str, many: int = _MANY // 2) -> None:
    """Put the live commit records in one file if there are ``many`` files of them, as every 200th commit does by itself.

    The new file is complete before the old ones go; records that are there twice count once.
    """
    folder = _below(path, COMMITS)
    files = [r[0] for r in spark.read.format("binaryFile").load(folder).select("path").toLocalIterator()]
    if len(files) < many:
        return
    materialize(live_commits(spark, path), "commits").coalesce(1).write.mode("append").json(folder)
    for file in files:
        remove_folder(spark, file)


def vacuum(spark: SparkSession, path: str, names: list[str], keep_seconds: float = 7 * 86_400) -> int:
    """Remove versions that no live commit names and that are older than ``keep_seconds``, for readers and writers still at work; returns how many."""
    live = {r[0] for r in live_commits(spark, path).select("version").toLocalIterator()}
    hadoop, removed = spark._jvm.org.apache.hadoop.fs.Path, 0
    for name in names:
        top = hadoop(_below(path, name))
        store = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if not store.exists(top):
            continue
        for status in store.listStatus(top):
            folder = status.getPath().getName()
            old = status.getModificationTime() <= (time.time() - keep_seconds) * 1000
            if folder.startswith("version=") and folder.removeprefix("version=") not in live and old:
                removed += remove_folder(spark, status.getPath().toString())
    return removed
