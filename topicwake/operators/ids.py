"""Consecutive numbering and running counts without a global window.

A window without partition keys would pull the whole table into one task. Here a row's position is
the sum of a small offset, taken from per-bucket totals, and its rank inside a bounded bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicwake.session import materialize

# A bucket spans 2^16 ids, so with unique ids it holds at most that many rows, whatever the data; a
# block spans 2^24 buckets.
_BUCKET_BITS = 16
_BLOCK_BITS = 24
_RANGE_ROWS = 1 << 22


def _sum_before(value: str, order: str, *partition: str) -> Column:
    window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def _span(col: str, bits: int) -> Column:
    return F.coalesce(F.shiftright(col, bits), F.lit(0).cast("long"))


def rows_before(df: DataFrame, id_col: str, counted: Column | None = None, name: str = "before") -> DataFrame:
    """Add how many ``counted`` rows (default: all) have a smaller id. Ids must be unique longs.

    Totals of 2^16 ids are summed up to totals of 2^40 ids. The last, unpartitioned sum runs over the
    latter: one row for a dense table of 10^12 rows, 2^23 rows for the most scattered ids possible.
    Only id and flag move to the bucket; the counts are joined back by id, so no bucket ever gathers
    texts. A row without an id gets no count. Buckets and blocks are declared non-null, so that Spark adds no
    null checks to one use of the totals and can compute them once for both.
    """
    hit = F.lit(1) if counted is None else F.when(counted, 1).otherwise(0)
    keyed = df.select(F.col(id_col), hit.alias("_hit")).where(F.col(id_col).isNotNull())
    keyed = keyed.withColumn("_bucket", _span(id_col, _BUCKET_BITS))
    buckets = keyed.groupBy("_bucket").agg(F.sum("_hit").alias("_n")).withColumn(
        "_block", _span("_bucket", _BLOCK_BITS)
    )
    blocks = buckets.groupBy("_block").agg(F.sum("_n").alias("_block_n"))
    block_offsets = blocks.select("_block", _sum_before("_block_n", "_block").alias("_block_offset"))
    offsets = buckets.join(block_offsets, "_block").select(
        "_bucket", (F.col("_block_offset") + _sum_before("_n", "_bucket", "_block")).alias("_offset")
    )
    counts = keyed.join(offsets, "_bucket").select(
        id_col, (F.col("_offset") + _sum_before("_hit", id_col, "_bucket")).alias(name)
    )
    return counts if df.columns == [id_col] else df.join(counts, id_col, "left")


def dense_id(df: DataFrame, order_cols: list[str], name: str = "id", partitions: int | None = None) -> DataFrame:
    """Number rows 0, 1, 2, … in the order of ``order_cols``, which must identify a row.

    Range partitions on the whole key, more of them for a longer table, split a hot leading value over several tasks. The placed rows
    are written once, so that counting and numbering see the same placement even if an executor is
    lost in between. The offsets table has one row per partition and is therefore safe to broadcast.
    """
    if partitions is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(least, -(-df.count() // _RANGE_ROWS))
    placed = materialize(
        df.repartitionByRange(partitions, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_place", F.monotonically_increasing_id()),
        "placed",
    )
    part = F.shiftright("_place", 33)
    totals = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = totals.select("_part", _sum_before("_n", "_part").alias("_offset"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_place", "_offset")
    )
