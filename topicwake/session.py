"""Spark session for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from topicwake.sources.stores import remove_folder

#: Splits from which a scan keeps a cluster busy by itself.
SPLITS = 32
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(name: str = "topicwake", cpus: int | str = 8) -> SparkSession:
    """Session for tests and the benchmark; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``, or one beside the warehouse where that is unset.

    The warehouse is a Hadoop path that all executors write tables to, so a table there survives the
    machine that wrote it, unlike a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_topicwake"


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path below one folder per application, which may be deleted once that has ended."""
    return f"{shared_folder(spark)}/topicwake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint does, but the copy is columnar, so later readers
    prune columns and push filters, and it survives the loss of any executor. Nothing reads the shuffle files of this write
    again, so Spark removes them as it ends, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`materialize` wrote, once nothing reads them any more: no result that is still to be worked out."""
    for table in tables:
        remove_folder(table.sparkSession, table._written)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of ended jobs removed now. Spark removes them once the driver has collected the plans that made them,
    which it may not do for half an hour; a long operator calls this between its phases."""
    gc.collect()
    spark._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Spread a small scan over all cores before CPU-heavy work.

    A few row groups keep a few tasks busy while the other cores wait. A scan of ``SPLITS`` splits or more, 4 GB
    at the usual size, is left alone on any cluster: no corpus is shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= min(cores, SPLITS) else df.repartition(3 * min(cores, SPLITS))
