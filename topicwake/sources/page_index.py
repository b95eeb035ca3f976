"""A stage sorted by id once, with a sparse index, so that any page of it is a range of one or two files.

    <path>/rows     the rows by ranges of their id, sorted, with ``_place``: the part in the upper bits, the place in it in the lower 33
    <path>/index    one entry for every 2^16 rows of a file: where they begin in the whole order, and the range of their ids
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY_BITS, _PART_BITS = 16, 33
#: Rows of a parquet page, the least that a read of a range fetches.
_PAGE_ROWS = 1000


def build_page_index(df: DataFrame, path: str, id_col: str = "id", partitions: int | None = None) -> None:
    """Write ``df`` sorted by its id and the index of it below ``path``. Rows without an id come first, equal ids in any order.

    The rows move once. The index is made from the ids and places that were written.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(id_col).asc_nulls_first()
    placed = df.repartitionByRange(parts, order).sortWithinPartitions(order).withColumn("_place", F.monotonically_increasing_id())
    placed.write.mode("overwrite").option("parquet.page.row.count.limit", _PAGE_ROWS).parquet(f"{path}/rows")
    rows = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    entries = rows.groupBy(F.col("_metadata.file_path").alias("file"), F.shiftright("_place", ENTRY_BITS).alias("entry")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_place").alias("least_place"),
        F.max("_place").alias("greatest_place"),
        F.min(id_col).alias("least_id"),
        F.max(id_col).alias("greatest_id"),
    )
    entries = entries.withColumn("part", F.shiftright("least_place", _PART_BITS))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = entries.groupBy("part").agg(F.sum("n").alias("all"))  # a row a part
    bases = sums.select("part", F.coalesce(F.sum("all").over(before.orderBy("part")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n").over(before.partitionBy("part").orderBy("entry")), F.lit(0))
    start = (F.col("base") + inside).alias("start")
    names = ["file", "n", "least_place", "greatest_place", "least_id", "greatest_id"]
    entries.join(bases, "part").select(start, *names).write.mode("overwrite").parquet(f"{path}/index")


def count_rows(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(f"{path}/index").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_range(spark: SparkSession, path: str, schema: T.StructType, start: int, n: int) -> DataFrame:
    """The rows from ``start`` (0 is the first) to before ``start + n`` in id order, and their ``_place``; unsorted.

    Reads the index, of which the driver gets the entries that the range meets, and of the rows the files and pages these name.
    """
    index = spark.read.parquet(f"{path}/index")
    met = index.where((F.col("start") < start + n) & (F.col("start") + F.col("n") > start)).collect()
    held = T.StructType([*schema.fields, T.StructField("_place", T.LongType())])
    if not met:
        return spark.createDataFrame([], held)
    places = []
    for e in met:
        lo = e.least_place + max(0, start - e.start)
        places.append(F.col("_place").between(lo, min(e.greatest_place, e.least_place + start + n - 1 - e.start)))
    return spark.read.schema(held).parquet(*{e.file for e in met}).where(reduce(lambda a, b: a | b, places))


def read_page(spark: SparkSession, path: str, schema: T.StructType, number: int, page_size: int = 10) -> DataFrame:
    """Page ``number`` (from 1) in id order; empty behind the last one."""
    rows = read_range(spark, path, schema, page_size * (number - 1), page_size)
    return rows.orderBy("_place").drop("_place")  # page_size rows
