"""The schemas of the stages. Writers never infer a schema from the rows of one batch."""

from __future__ import annotations

from pyspark.sql import types as T

CORPUS = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("score", T.FloatType()),
        T.StructField("reddit_scores", T.ArrayType(T.LongType())),
    ]
)

RAW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("reddit_scores", T.ArrayType(T.LongType())),
    ]
)

NORMALIZED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("original_length", T.IntegerType()),
        T.StructField("normalized_length", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("reddit_scores", T.ArrayType(T.LongType())),
    ]
)

MODELED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("original_length", T.IntegerType()),
        T.StructField("normalized_length", T.IntegerType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("dominant_topic", T.IntegerType()),
        T.StructField("topic_distribution", T.ArrayType(T.DoubleType())),
        T.StructField("top_words", T.ArrayType(T.StringType())),
        T.StructField("window_id", T.LongType()),
        T.StructField("drift_detected", T.BooleanType()),
        T.StructField("js_divergence", T.DoubleType()),
        T.StructField("drift_magnitude", T.StringType()),
    ]
)

#: The stage tables.
RAW_TABLE = T.StructType([*RAW.fields[:4], T.StructField("reddit_scores", T.StringType())])
PROCESSED = T.StructType([NORMALIZED[n] for n in ("id", "text", "original_length", "normalized_length", "score")])
FEATURES = T.StructType(
    [
        MODELED[n]
        for n in (
            "id",
            "text",
            "title",
            "score",
            "original_length",
            "normalized_length",
            "model_version",
            "dominant_topic",
            "topic_distribution",
            "top_words",
            "window_id",
            "drift_detected",
            "js_divergence",
            "drift_magnitude",
        )
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("batch_num", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("id_range_min", T.LongType()),
        T.StructField("id_range_max", T.LongType()),
    ]
)
