import json

import pytest
from pyspark.sql import functions as F

from topicwake import schemas
from topicwake.functions import scalars
from topicwake.plans.modeling import Params, analyse_corpus
from topicwake.sources import stage_tables

def clock():
    return F.timestamp_seconds(F.lit(1704164645))


def modeled(spark, n=25):
    df = spark.range(n).select(
        "id", F.concat(F.lit("text "), "id").alias("text"), F.lit(7).alias("original_length"), F.lit(3).alias("normalized_length")
    )
    for name in ("title", "score", "dominant_topic", "topic_distribution", "top_words", "window_id", "drift_detected", "js_divergence", "drift_magnitude"):
        kind = next(f.dataType for f in schemas.MODELED if f.name == name)
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def test_modeled_record_defaults(spark):
    got = stage_tables.modeled_record(modeled(spark, 1), "v9")
    assert got.schema.simpleString() == schemas.MODELED.simpleString()
    assert tuple(got.first()) == (0, "", "text 0", 0.0, 7, 3, "v9", -1, [], [], 0, False, 0.0, "none")


def test_batches_and_manifest(spark):
    df = spark.createDataFrame([(i * 7 + 3,) for i in range(25)], "id long").repartition(3)
    manifest = stage_tables.batch_manifest(stage_tables.numbered_batches(df, 10), clock())
    rows = stage_tables.named_batches(manifest).orderBy("batch_num").collect()
    assert [tuple(r)[:5] for r in rows] == [
        (1, "20240102_030405", 10, 3, 66),
        (2, "20240102_030405", 10, 73, 136),
        (3, "20240102_030405", 5, 143, 171),
    ]
    assert rows[2].batch_name == "batch_000003_20240102_030405"


def test_stamps_are_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        row = spark.range(1).select(scalars.utc_stamp(clock()), scalars.utc_iso(clock())).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == ("20240102_030405", "2024-01-02T03:04:05.000000")


def test_json_list(spark):
    df = spark.createDataFrame([([1, 2],), ([],)], "v array<bigint>")
    assert [json.loads(r[0]) for r in df.select(scalars.json_list(F.col("v"))).collect()] == [[1, 2], []]
    assert df.select(scalars.json_list(F.col("v"))).first()[0] == "[1, 2]"


def test_write_stages(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = stage_tables.modeled_record(modeled(spark))
    raw = spark.range(25).select(
        "id", F.lit("T").alias("title"), F.lit("Raw!").alias("text"), F.lit(0.5).alias("score"), F.array(F.lit(4)).alias("reddit_scores")
    )
    for _ in range(2):  # a second run replaces the first
        stage_tables.write_stages(rows, out, clock(), raw=raw, batch_size=10)
    assert stage_tables.read_stage(spark, out, "RAW").orderBy("id").first().asDict() == {
        "id": 0, "title": "T", "text": "Raw!", "score": 0.5, "reddit_scores": "[4]"
    }
    assert stage_tables.read_stage(spark, out, "PROCESSED").columns == ["id", "text", "original_length", "normalized_length", "score"]
    features = stage_tables.read_stage(spark, out, "FEATURES")
    assert features.count() == 25 and features.columns[:3] == ["id", "text", "title"] and len(features.columns) == 14
    manifest = stage_tables.read_stage(spark, out, "METADATA").orderBy("batch_num").collect()
    assert [r.record_count for r in manifest] == [10, 10, 5]


def test_the_corpus_folder_is_no_target(spark, tmp_path):
    for source, target in (("a", "a"), ("a", "a/out"), ("a/in", "a")):
        with pytest.raises(ValueError):
            stage_tables.write_stages(modeled(spark), f"{tmp_path}/{target}", clock(), source=f"{tmp_path}/{source}")


def test_whole_run_over_a_corpus(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    corpus = docs.orderBy("doc_id").select(F.lit("A Title").alias("title"), "text").coalesce(1)
    corpus.write.parquet(str(tmp_path / "in"))
    params = Params(topics=4, window=20, epochs=3)
    analysis = analyse_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), clock(), params)
    features = stage_tables.read_stage(spark, str(tmp_path / "out"), "FEATURES").orderBy("id").collect()
    assert [r.id for r in features] == list(range(200))
    assert [r.window_id for r in features] == [i // 20 for i in range(200)]
    windows = {r.window_id: r for r in analysis.windows.collect()}
    assert sorted(windows) == list(range(10))
    for r in features:
        w = windows[r.window_id]
        wanted = (w.drift_detected, w.js_divergence, w.drift_magnitude) if r.id % 20 == 19 else (False, 0.0, "none")
        assert (r.drift_detected, r.js_divergence, r.drift_magnitude) == wanted
        assert sum(r.topic_distribution) == pytest.approx(1, abs=1e-3) and len(r.top_words) == 10
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.id: r.text for r in stage_tables.read_stage(spark, str(tmp_path / "out"), "RAW").collect()} == texts
    processed = stage_tables.read_stage(spark, str(tmp_path / "out"), "PROCESSED").collect()
    assert all(r.original_length == len(texts[r.id]) and r.normalized_length == len(r.text) for r in processed)
    assert stage_tables.read_stage(spark, str(tmp_path / "out"), "METADATA").count() == 2
