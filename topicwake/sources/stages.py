"""Stages as streams of JSON rows, on any streaming source and sink Spark has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

_BROKEN = "_corrupt_record"


def decode_stage(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of a JSON ``value`` column and, apart from them, the values that could not be decoded."""
    tolerant = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    value = F.col("value").cast("string")
    decoded = lines.select(
        value.alias("value"),
        F.from_json(value, tolerant, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}).alias("row"),
    )
    broken = F.col("row").isNull() | F.col(f"row.{_BROKEN}").isNotNull()
    good = decoded.where(~broken).select(*[F.col(f"row.{name}").alias(name) for name in schema.fieldNames()])
    return good, decoded.where(broken).select("value")


def encode_stage(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def read_stage_stream(
    spark: SparkSession, fmt: str, schema: T.StructType, **options: str
) -> tuple[DataFrame, DataFrame]:
    """Subscribe to a stage from its beginning: (good rows, undecodable values).

    ``fmt`` is ``kafka`` where the connector is on the class path, or for instance ``text`` for a
    folder of JSON lines. The place in the stream lives in the checkpoint of the query that reads it.
    """
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", **options}
    return decode_stage(spark.readStream.format(fmt).options(**options).load(), schema)


def write_stage_stream(df: DataFrame, fmt: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """Publish rows as JSON, without a key; call ``start()`` on the result."""
    return encode_stage(df).writeStream.format(fmt).options(checkpointLocation=checkpoint, **options)
