"""The files of a stage or corpus: a stored table, kept up to date by looking into new files only."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwake.session import materialize
from topicwake.sources.stores import open_store

#: A row a file: its address, its size and time, its columns' types by name as JSON, its rows, and the range of its ids.
SCHEMA = (
    "file_path string, file_size long, modified timestamp, columns string, n_rows long, least_id long, greatest_id long"
)
_NESTED = "list<{}>"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_size, modified) of the parquet files below ``path``, named as a scan names them; no file is opened."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    )
    return files.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified")
    )


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return _NESTED.format(kind.value_type)
    return str(kind)


def _id_range(meta: pq.FileMetaData, id_col: str) -> tuple[int | None, int | None]:
    """Least and greatest id by the statistics of the row groups; unknown where one has none."""
    names = [meta.schema.column(i).path for i in range(meta.num_columns)]
    if id_col not in names:
        return None, None
    at, least, greatest = names.index(id_col), [], []
    for g in range(meta.num_row_groups):
        found = meta.row_group(g).column(at).statistics
        if found is None or (not found.has_min_max and found.null_count != meta.row_group(g).num_rows):
            return None, None
        if found.has_min_max:
            least.append(found.min)
            greatest.append(found.max)
    whole = bool(least) and all(isinstance(x, int) for x in (*least, *greatest))
    return (min(least), max(greatest)) if whole else (None, None)


def inspect_files(files: DataFrame, id_col: str = "id") -> DataFrame:
    """The inventory rows of ``files``: tasks read the footers, one task those of many files.

    The driver opens no file. A store that the executors' Arrow cannot open is an error that names the file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column(0).to_pylist():
                store, name = open_store(uri)
                with store.open_input_file(name) as f:
                    footer = pq.ParquetFile(f)
                    columns = json.dumps({x.name: _kind(x.type) for x in footer.schema_arrow})
                    found.append((columns, footer.metadata.num_rows, *_id_range(footer.metadata, id_col)))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.record_batch([*batch.columns, *columns], names=names)

    spark = files.sparkSession
    tasks = max(1, min(files.count(), 64 * spark.sparkContext.defaultParallelism))
    return files.repartition(tasks, "file_path").mapInArrow(read, SCHEMA)


def inventory(spark: SparkSession, table: str) -> DataFrame:
    """The stored inventory rows, those of replaced and removed files too; none if there is no such table yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(table)
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)


def update_inventory(spark: SparkSession, path: str, table: str, id_col: str = "id") -> DataFrame:
    """Bring the inventory ``table`` of the folder ``path`` up to date; returns the rows of the files that are there now.

    Only files that the table does not name with their size and time are opened. Rows are appended, so a reader sees the
    inventory before or after an update. A file replaced by another counts with its new row, a removed file no longer. Two updates at one time
    may look into a file twice, which leaves equal rows; such a file counts once.
    """
    key = ["file_path", "file_size", "modified"]
    files = materialize(list_files(spark, path), "listing")
    fresh = files.join(inventory(spark, table).select(*key), key, "left_anti")
    if not fresh.isEmpty():
        inspect_files(fresh, id_col).write.mode("append").parquet(table)
    return inventory(spark, table).join(files, key, "left_semi").dropDuplicates(key)


def inspect_folder(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """The inventory of a folder that has no stored one."""
    return materialize(inspect_files(list_files(spark, path), id_col), "inventory")
