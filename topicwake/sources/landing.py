"""Land source files that are not there yet."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from topicwake.session import materialize
from topicwake.sources.stores import open_store

_CHUNK = 4 << 20
_MANIFEST = "file_name string"
_OUTCOME = "file_name string, landed boolean, message string"


def skip_landed(source: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Rows of the source listing whose key has not landed."""
    return source.join(landed.select(key), key, "left_anti")


class LandingError(RuntimeError):
    """Some files did not land; ``outcomes`` (file_name, landed, message) tells of each why."""

    def __init__(self, outcomes: DataFrame):
        failed = outcomes.where("not landed").orderBy("file_name").limit(20).collect()
        super().__init__("not landed: " + "; ".join(f"{r.file_name}: {r.message}" for r in failed))
        self.failed = [r.file_name for r in failed]
        self.outcomes = outcomes


def landed_files(spark: SparkSession, manifest: str) -> DataFrame:
    """(file_name) of every file recorded as landed in the manifest, none if there is no manifest yet."""
    try:
        return spark.read.schema(_OUTCOME).json(manifest).where("coalesce(landed, true)").select("file_name")
    except AnalysisException:
        return spark.createDataFrame([], _MANIFEST)


def _stage(source: str, target: str, name: str) -> str:
    """Copy the file as it is, chunk by chunk, to a name of its own that no scan reads; returns that name."""
    store, path = open_store(source)
    out, folder = open_store(target)
    with store.open_input_file(path) as f:
        pq.read_schema(f)  # refuses what is no parquet file
    out.create_dir(folder, recursive=True)
    staged = f"_{name}.{uuid.uuid4().hex}"
    with store.open_input_stream(path) as read, out.open_output_stream(f"{folder}/{staged}") as write:
        while chunk := read.read(_CHUNK):
            write.write(chunk)
    return staged


@dataclass
class Staged(WriterCommitMessage):
    """What a task has copied: (file name, staged name or None, message or None) of each of its files."""

    files: list[tuple[str, str | None, str | None]]


class LandingWriter(DataSourceArrowWriter):
    """Tasks stage files; the commit of the whole job gives them their names and records them, in one part of the manifest."""

    def __init__(self, target: str, manifest: str, job: str):
        self.target, self.manifest, self.job = target, manifest, job

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        files: list[tuple[str, str | None, str | None]] = []
        for batch in iterator:
            for name, path in zip(batch.column("file_name").to_pylist(), batch.column("path").to_pylist()):
                try:
                    files.append((name, _stage(path, self.target, name), None))
                except (OSError, pa.ArrowException) as error:
                    files.append((name, None, str(error)[:500]))
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        store, folder = open_store(self.target)
        rows = [row for m in messages if m for row in m.files]
        for name, staged, _ in rows:
            if staged:
                store.move(f"{folder}/{staged}", f"{folder}/{name}")
        if rows:
            out, place = open_store(self.manifest)
            out.create_dir(place, recursive=True)
            with out.open_output_stream(f"{place}/{self.job}.json") as part:
                for name, staged, message in rows:
                    part.write((json.dumps({"file_name": name, "landed": staged is not None, "message": message}) + "\n").encode())

    def abort(self, messages: list[Staged | None]) -> None:
        store, folder = open_store(self.target)
        for _, staged, _ in (row for m in messages if m for row in m.files):
            if staged:
                store.delete_file(f"{folder}/{staged}")


class LandingSource(DataSource):
    """``write.format("topicwake_landing")`` of rows (file_name, path); options target, manifest and job."""

    @classmethod
    def name(cls) -> str:
        return "topicwake_landing"

    def writer(self, schema: T.StructType, overwrite: bool) -> LandingWriter:
        return LandingWriter(self.options["target"], self.options["manifest"], self.options["job"])


def land_new_files(spark: SparkSession, source: str, target: str, manifest: str) -> DataFrame:
    """Copy the parquet files of ``source`` that the manifest does not name; (file_name, landed, message) of each.

    Tasks stage copies of their files as they are, with all columns, under names that no scan reads. When all tasks have ended, the job's commit
    gives the files their names and records all outcomes in one part of the manifest. A job that breaks off before leaves nothing that a reader
    sees; one that breaks off while it commits has its files copied again under the same names. A file that fails does not stop the others, and a
    rerun tries it again. Tasks and commit open the folders by :func:`~topicwake.sources.stores.open_store`.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(source)
    wanted = listing.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path")
    new = materialize(skip_landed(wanted, landed_files(spark, manifest), "file_name"), "to-land")
    job = uuid.uuid4().hex
    spark.dataSource.register(LandingSource)
    spread = new.select("file_name", "path").repartition(4 * spark.sparkContext.defaultParallelism, "file_name")
    spread.write.format(LandingSource.name()).mode("append").options(target=target, manifest=manifest, job=job).save()
    try:
        outcomes = spark.read.schema(_OUTCOME).json(f"{manifest.rstrip('/')}/{job}.json")
    except AnalysisException:  # no new files, no part
        return spark.createDataFrame([], _OUTCOME)
    if not outcomes.where("not landed").isEmpty():
        raise LandingError(outcomes)
    return outcomes
