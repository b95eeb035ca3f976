"""What the overview needs of each batch, kept with the batch and merged instead of rescanned.

    SUMMARY        a row a batch: counts, sums, the first row's model version, topics, sketches of both lengths
    WINDOW_SETS    the batch's windows, and those with drift, as bit sets of 2^15 windows a row

Counts, sums and sets merge exactly, sketches within their rank error. A batch that is written again brings its summary along, since both are
part of its commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicwake.sources.commits import read_committed

#: Size of a sketch; the rank of a merged quantile is then off by less than 0.4 %.
SKETCH_K = 1000
SUMMARY = (
    T.StructType()
    .add("records", "long").add("original_sum", "long").add("original_n", "long").add("normalized_sum", "long").add("normalized_n", "long")
    .add("first_id", "long").add("model_version", "string").add("topics", T.ArrayType(T.IntegerType()))
    .add("original_min", "long").add("original_max", "long").add("normalized_min", "long").add("normalized_max", "long")
    .add("original_sketch", "binary").add("normalized_sketch", "binary")
)
WINDOW_SETS = T.StructType().add("kind", "string").add("bucket", "long").add("windows", "binary")


def summarize(features: DataFrame) -> DataFrame:
    """The summary of a batch of modeled rows, one row; of no rows, one row of zeros and nulls."""
    aggregates = [
        F.count(F.lit(1)).alias("records"),
        F.min(F.when(F.col("model_version").isNotNull(), F.col("id"))).alias("first_id"),
        F.min_by("model_version", F.when(F.col("model_version").isNotNull(), F.col("id"))).alias("model_version"),
        F.sort_array(F.collect_set("dominant_topic")).alias("topics"),  # k + 1 of them
    ]
    for side in ("original", "normalized"):
        length = F.col(f"{side}_length").cast("long")
        aggregates += [
            F.coalesce(F.sum(length), F.lit(0)).alias(f"{side}_sum"),
            F.count(length).alias(f"{side}_n"),
            F.min(length).alias(f"{side}_min"),
            F.max(length).alias(f"{side}_max"),
            F.kll_sketch_agg_bigint(length, SKETCH_K).alias(f"{side}_sketch"),
        ]
    return features.agg(*aggregates).select(*SUMMARY.fieldNames())


def window_sets(features: DataFrame) -> DataFrame:
    """(kind, bucket, windows) of the windows of a batch (``all``) and of those with drift (``drift``)."""
    kinds = F.when(F.col("drift_detected"), F.array(F.lit("all"), F.lit("drift"))).otherwise(F.array(F.lit("all")))
    rows = features.where(F.col("window_id").isNotNull()).select("window_id", F.explode(kinds).alias("kind"))
    bucket = F.bitmap_bucket_number("window_id").alias("bucket")
    return rows.groupBy("kind", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("window_id")).alias("windows"))


def overview_merged(spark: SparkSession, path: str) -> DataFrame:
    """The overview of all batches committed below ``path``, by their summaries; equal to that of all rows."""
    batches = read_committed(spark, path, "SUMMARY", SUMMARY)
    sets = read_committed(spark, path, "WINDOW_SETS", WINDOW_SETS)
    merged = sets.groupBy("kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("windows")).alias("n"))
    of = lambda kind: merged.where(F.col("kind") == kind).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    topics = batches.select(F.explode("topics").alias("t")).agg(F.count_distinct("t")).scalar()
    totals = batches.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.try_divide(F.sum("original_sum"), F.sum("original_n")).alias("avg_original_length"),
        F.try_divide(F.sum("normalized_sum"), F.sum("normalized_n")).alias("avg_normalized_length"),
        F.min_by("model_version", "first_id").alias("model_version"),
    )
    return totals.withColumns({"topics_detected": topics, "drift_windows": of("drift"), "windows": of("all")})


def lengths_merged(spark: SparkSession, path: str, ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(type, n, min_len, max_len, quantiles) of both lengths over all batches: least and greatest exact, quantiles within the rank error."""
    batches = read_committed(spark, path, "SUMMARY", SUMMARY)
    sides = [
        batches.select(
            F.lit(name).alias("type"),
            F.col(f"{side}_n").alias("n"),
            F.col(f"{side}_min").alias("least"),
            F.col(f"{side}_max").alias("greatest"),
            F.col(f"{side}_sketch").alias("sketch"),
        )
        for name, side in (("Original", "original"), ("Normalized", "normalized"))
    ]
    rows = sides[0].unionByName(sides[1]).where("n > 0").groupBy("type").agg(
        F.sum("n").alias("n"), F.min("least").alias("min_len"), F.max("greatest").alias("max_len"), F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch")
    )
    quantiles = F.array(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)) for p in ranks])
    return rows.select("type", "n", "min_len", "max_len", quantiles.alias("quantiles"))
