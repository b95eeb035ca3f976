from pyspark.sql import functions as F

from topicwake.sources.stage_tables import modeled_record


def modeled_rows(spark, start, end):
    rows = spark.range(start, end).select(
        "id",
        F.lit("t").alias("title"),
        F.lit("clean words").alias("text"),
        F.lit(1.0).alias("score"),
        F.lit(20).alias("original_length"),
        F.lit(11).alias("normalized_length"),
        (F.col("id") % 2).cast("int").alias("dominant_topic"),
        F.array(F.lit(0.5), F.lit(0.5)).alias("topic_distribution"),
        F.array(F.lit("w")).alias("top_words"),
        F.lit(0).alias("window_id"),
        F.lit(False).alias("drift_detected"),
        F.lit(0.0).alias("js_divergence"),
        F.lit("none").alias("drift_magnitude"),
    )
    return modeled_record(rows)
