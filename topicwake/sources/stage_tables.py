"""The stage tables RAW, PROCESSED, FEATURES and the batch manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicwake import schemas
from topicwake.functions.scalars import batch_name, json_list, utc_stamp
from topicwake.operators.ids import rows_before
from topicwake.sources.commits import commit_tables, read_committed
from topicwake.sources.summaries import summarize, window_sets

BATCH_SIZE = 100
# Fixed value: the label written when the caller names no model.
MODEL_VERSION = "sklearn-lda-v1"


def modeled_record(df: DataFrame, model_version: str = MODEL_VERSION) -> DataFrame:
    """Scored rows with drift results in the modeled schema, every field cast and defaulted."""
    types = {f.name: f.dataType for f in schemas.MODELED}
    defaults = {
        "title": F.lit(""),
        "text": F.lit(""),
        "score": F.lit(0.0),
        "original_length": F.lit(0),
        "normalized_length": F.lit(0),
        "dominant_topic": F.lit(-1),
        "topic_distribution": F.array(),
        "top_words": F.array(),
        "window_id": F.lit(0),
        "drift_detected": F.lit(False),
        "js_divergence": F.lit(0.0),
        "drift_magnitude": F.lit("none"),
    }

    def field(name: str) -> Column:
        if name == "model_version":
            return F.lit(model_version)
        value = F.col(name).cast(types[name])
        return F.coalesce(value, defaults[name].cast(types[name])) if name in defaults else value

    return df.select(*[field(name).alias(name) for name in schemas.MODELED.fieldNames()])


def raw_table(raw: DataFrame) -> DataFrame:
    """RAW: the texts as read, with the score list as JSON text."""
    scores = F.coalesce("reddit_scores", F.array()) if "reddit_scores" in raw.columns else F.array()
    return raw.select(
        "id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        json_list(scores.cast("array<bigint>")).alias("reddit_scores"),
    )


def processed_table(normalized: DataFrame) -> DataFrame:
    """PROCESSED: clean text and lengths."""
    return normalized.select(
        "id",
        F.coalesce("text", F.lit("")).alias("text"),
        "original_length",
        "normalized_length",
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def features_table(modeled: DataFrame) -> DataFrame:
    """FEATURES: the modeled columns with their defaults."""
    defaults = {
        "title": F.lit(""),
        "text": F.lit(""),
        "score": F.lit(0.0),
        "dominant_topic": F.lit(-1),
        "topic_distribution": F.array().cast("array<double>"),
        "top_words": F.array().cast("array<string>"),
        "window_id": F.lit(0).cast("long"),
        "drift_detected": F.lit(False),
        "js_divergence": F.lit(0.0),
        "drift_magnitude": F.lit("none"),
    }
    return modeled.select(*[F.coalesce(n, defaults[n]).alias(n) if n in defaults else n for n in schemas.FEATURES.fieldNames()])


def split_stages(
    modeled: DataFrame, raw: DataFrame | None = None, normalized: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The three tables. RAW and PROCESSED come from their own stages where these are given: RAW then
    holds the real texts, and PROCESSED does without topics and drift."""
    return {
        "raw": raw_table(modeled if raw is None else raw),
        "processed": processed_table(modeled if normalized is None else normalized),
        "features": features_table(modeled),
    }


def numbered_batches(df: DataFrame, batch_size: int = BATCH_SIZE, dense: bool = False) -> DataFrame:
    """Add ``batch_num``: 1 for the first ``batch_size`` rows in id order, and so on; the last is short."""
    placed = df.withColumn("_place", F.col("id")) if dense else rows_before(df, "id", name="_place")
    return placed.withColumn("batch_num", F.expr(f"_place div {batch_size} + 1")).drop("_place")


def batch_manifest(batched: DataFrame, clock: Column) -> DataFrame:
    """One row per batch; ``clock`` is the time of writing."""
    return (
        batched.groupBy("batch_num")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min("id").alias("id_range_min"),
            F.max("id").alias("id_range_max"),
        )
        .select(
            "batch_num", utc_stamp(clock).alias("timestamp"), "record_count", "id_range_min", "id_range_max"
        )
    )


def named_batches(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("batch_name", batch_name(F.col("batch_num"), F.col("timestamp")))


#: The tables of a batch, and how each is read.
TABLES = {"RAW": schemas.RAW_TABLE, "PROCESSED": schemas.PROCESSED, "FEATURES": schemas.FEATURES, "METADATA": schemas.MANIFEST}


def write_stages(
    modeled: DataFrame,
    path: str,
    clock: Column,
    raw: DataFrame | None = None,
    normalized: DataFrame | None = None,
    source: str | None = None,
    batch_size: int = BATCH_SIZE,
    batch: str = "",
    dense: bool = False,
    batch_num: int | None = None,
    summaries: bool = False,
) -> str:
    """Write RAW, PROCESSED and FEATURES as parquet and METADATA as JSON below ``path``, visible all at once; returns the version.

    Each table reads only its own columns, so ``modeled`` should rest on a written table.
    ``batch`` names what this call writes, such as ``batch_id=7``; a replay replaces it as a whole. ``batch_num``
    makes all rows one batch of the manifest. ``summaries`` adds what :mod:`~topicwake.sources.summaries` keeps of a batch, so that the overview
    need not read its rows. Read with :func:`read_stage`. Writing into the corpus folder is refused, since the files
    would be read as new documents.
    """
    if source is not None and _overlaps(source, path):
        raise ValueError("the stage tables must not be written into the corpus folder")
    ids = (modeled if raw is None else raw).select("id")

    def manifest(folder: str) -> None:
        batched = numbered_batches(ids, batch_size, dense) if batch_num is None else ids.withColumn("batch_num", F.lit(batch_num).cast("long"))
        batch_manifest(batched, clock).write.json(folder)

    tables = {name.upper(): table.write.parquet for name, table in split_stages(modeled, raw, normalized).items()}
    kept = {"SUMMARY": summarize(modeled).coalesce(1).write.parquet, "WINDOW_SETS": window_sets(modeled).write.parquet} if summaries else {}
    return commit_tables(modeled.sparkSession, path, {**tables, "METADATA": manifest, **kept}, batch)


def read_stage(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of ``TABLES`` as the latest commit of each batch left it; empty if nothing has been committed."""
    return read_committed(spark, path, name, TABLES[name], "json" if name == "METADATA" else "parquet")


def _overlaps(a: str, b: str) -> bool:
    a, b = a.rstrip("/") + "/", b.rstrip("/") + "/"
    return a.startswith(b) or b.startswith(a)
