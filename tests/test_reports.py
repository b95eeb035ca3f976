import random

import pytest
from pyspark.sql import functions as F

from topicwake.functions import scalars
from topicwake.plans import reports


def test_pages(spark):
    df = spark.range(25).select("id", F.concat(F.lit("t"), "id").alias("text"))
    assert [r.id for r in reports.page(df, 3).collect()] == [20, 21, 22, 23, 24]
    assert reports.page(df, 4).count() == 0
    assert tuple(reports.pages(df).first()) == (25, 3)
    assert tuple(reports.pages(df.where("id < 0")).first()) == (0, 1)
    assert tuple(reports.pages(df.where("id < 20")).first()) == (20, 2)
    assert [r.id for r in reports.page(df, 2).collect()] == list(range(10, 20))
    texts = spark.range(30_000).select(F.format_string("k%06d", F.col("id")).alias("id")).repartition(7)
    assert [r.id for r in reports.page(texts, 1500).collect()] == [f"k{i:06d}" for i in range(14_990, 15_000)]


def test_page_record(spark):
    one = features(spark).withColumn("text", F.lit("z" * 600))
    row = reports.text_page(one, 1).collect()[4]
    assert row.asDict() == {
        "id": 4, "dominant_topic": 0, "original_length": 4, "normalized_length": 2, "words": "r, s", "snippet": "z" * 500 + "...",
    }


def test_sample(spark):
    df = spark.range(300).repartition(7)
    first = sorted(r.id for r in reports.sample_n(df, 40).collect())
    assert first == sorted(r.id for r in reports.sample_n(df.coalesce(1), 40).collect())
    assert len(set(first)) == 40
    assert first != sorted(r.id for r in reports.sample_n(df, 40, seed=1).collect())
    assert reports.sample_n(df, 1000).count() == 300


def test_snippet_and_words(spark):
    df = spark.createDataFrame([("x" * 500, ["a", "b", "c"]), ("y" * 501, [])], "t string, w array<string>")
    rows = df.select(scalars.snippet(F.col("t")), scalars.first_words(F.col("w"), 2)).collect()
    assert [tuple(r) for r in rows] == [("x" * 500, "a, b"), ("y" * 500 + "...", "")]


def test_empty_texts_are_left_out_of_the_reduction(spark):
    df = spark.createDataFrame([(0, 0), (10, 5), (4, 1)], "original_length int, normalized_length int")
    assert tuple(reports.normalization_impact(df).first()) == (pytest.approx(62.5), 8)


def test_boxplot_is_exact(spark):
    rng = random.Random(0)
    a = sorted(rng.randrange(1000) for _ in range(101))
    df = spark.createDataFrame([(x, x // 2) for x in a], "original_length int, normalized_length int")
    got = {r.type: tuple(r)[1:] for r in reports.length_boxplot(df).collect()}
    assert got["Original"] == (a[0], a[25], a[50], a[75], a[100])
    assert got["Normalized"] == tuple(x // 2 for x in (a[0], a[25], a[50], a[75], a[100]))


def features(spark):
    rows = [
        (0, 2, ["p"], 0, False, 0.0, "none", "v1"),
        (1, -1, [], 0, False, 0.0, "none", "v2"),
        (2, 2, ["q"], 0, True, 0.4, "high", "v2"),
        (3, 0, [], 1, None, None, None, "v2"),
        (4, 0, ["r", "s"], 1, True, 0.2, "high", "v2"),
    ]
    return spark.createDataFrame(
        rows,
        "id long, dominant_topic int, top_words array<string>, window_id long, drift_detected boolean,"
        " js_divergence double, drift_magnitude string, model_version string",
    ).withColumns({"original_length": F.lit(4), "normalized_length": F.when(F.col("id") > 0, 2)})


def test_feature_reports(spark):
    f = features(spark)
    assert reports.overview(f).first().asDict() == {
        "records": 5, "avg_original_length": 4.0, "avg_normalized_length": 2.0, "model_version": "v1",
        "topics_detected": 3, "drift_windows": 2, "windows": 2,
    }
    assert [tuple(r) for r in reports.docs_per_topic(f).collect()] == [("Topic -1", 1), ("Topic 0", 2), ("Topic 2", 2)]
    assert [tuple(r) for r in reports.topic_words_first(f).collect()] == [(0, "r, s"), (2, "p")]
    first = {r.window_id: tuple(r)[1:] for r in reports.window_stats_first(f).collect()}
    assert first == {0: (0.0, False, "none"), 1: (0.2, True, "high")}
    closing = {r.window_id: tuple(r)[1:] for r in reports.window_stats(f).collect()}
    assert closing == {0: (0.4, True, "high"), 1: (0.2, True, "high")}
    assert tuple(reports.avg_js(f).first()) == (pytest.approx(0.1), pytest.approx(0.3))
    assert [tuple(r) for r in reports.drift_event_log(f).collect()] == [(0, 0.4, "high"), (1, 0.2, "high")]
    shares = {(r.window_id, r.topic): r.share for r in reports.window_topic_share(f, [-1, 0, 1, 2]).collect()}
    assert shares[0, 2] == pytest.approx(2 / 3) and shares[1, 0] == 1.0 and shares[0, 1] == 0.0
    wide = {r.window_id: r.topic_2 for r in reports.window_topic_table(f, [-1, 0, 2]).collect()}
    assert wide == {0: pytest.approx(2 / 3), 1: 0.0}
    found = reports.window_topic_share(f, [0, 1]).collect()  # topics that are not listed stay
    assert {r.topic for r in found} == {-1, 0, 1, 2} and sum(r.share for r in found) == pytest.approx(2)
    assert reports.window_topic_table(f).columns == ["window_id", "topic_-1", "topic_0", "topic_2"]


def test_overview_of_nothing(spark):
    assert reports.overview(features(spark).where("id < 0")).first().asDict() == {
        "records": 0, "avg_original_length": None, "avg_normalized_length": None, "model_version": None,
        "topics_detected": 0, "drift_windows": 0, "windows": 0,
    }


def test_heatmap_takes_the_first_documents(spark):
    df = spark.range(80).select("id", F.array(F.lit(0.25), F.lit(0.75)).alias("topic_distribution")).repartition(5)
    rows = reports.topic_heatmap(df).collect()
    assert len(rows) == 100 and {r.id for r in rows} == set(range(50)) and {r.topic for r in rows} == {0, 1}


def test_reports_aggregate_without_sorting_the_rows(spark):
    f = features(spark)
    for report in (reports.overview, reports.window_stats_first, reports.window_stats, reports.topic_words_first):
        plan = report(f)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate(key=[window_id" not in plan and "SortAggregate(key=[dominant_topic" not in plan
