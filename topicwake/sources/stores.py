"""Arrow file systems for the addresses that Spark uses, and removal of folders through Spark's own."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

#: Spark's names of stores that Arrow knows by another name; all other schemes are handed on as they are.
_NAMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


class StoreError(OSError):
    """Arrow cannot open the store of an address."""


def arrow_address(uri: str) -> str:
    """The address of the same file for Arrow: ``s3a://b/k`` is ``s3://b/k``, a blob account is addressed by its file service."""
    found = re.match(r"(\w+)://(.*)", uri, re.S)
    if not found or found[1].lower() not in _NAMES:
        return uri
    scheme, rest = found[1].lower(), found[2]
    if scheme.startswith("wasb"):
        rest = rest.replace(".blob.", ".dfs.", 1)
    return f"{_NAMES[scheme]}://{rest}"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of an address, on a driver or an executor; :class:`StoreError` says which address it could not open."""
    try:
        return fs.FileSystem.from_uri(arrow_address(uri))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as error:
        raise StoreError(f"the executors' Arrow cannot open {uri}: {error}") from error


def remove_folder(spark: SparkSession, uri: str) -> bool:
    """Remove a folder and all it holds from any store that Spark can open; False if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
