import random

from pyspark.sql import functions as F

from topicwake.plans import reports
from topicwake.sources.stage_tables import modeled_record, write_stages
from topicwake.sources.summaries import lengths_merged, overview_merged


def rows_of(spark, ids, seed=1):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice([-1, 0, 3, 7, None]), i // 20 if i % 11 else None, i % 20 == 19 and rng.random() < 0.4, int(rng.lognormvariate(6, 1)), rng.choice([None, 5, 0]), f"v{i // 37}")
        for i in ids
    ]
    kinds = "id long, dominant_topic int, window_id long, drift_detected boolean, original_length int, normalized_length int, version string"
    blank = {"title": "string", "text": "string", "score": "double", "topic_distribution": "array<double>", "top_words": "array<string>", "js_divergence": "double", "drift_magnitude": "string"}
    df = spark.createDataFrame(rows, kinds).withColumns({n: F.lit(None).cast(k) for n, k in blank.items()})
    return modeled_record(df).withColumn("model_version", F.concat(F.lit("v"), F.expr("id div 37")))


def put(rows, out, batch):
    write_stages(rows, out, F.timestamp_seconds(F.lit(0)), batch=batch, batch_num=1, summaries=True)


def test_merged_equals_scanned(spark, tmp_path):
    """Four batches whose windows cross, one of them empty, one written again with other rows."""
    out = str(tmp_path / "out")
    parts = [rows_of(spark, range(0, 150)), rows_of(spark, []), rows_of(spark, range(150, 1010)), rows_of(spark, range(1010, 1500))]
    put(rows_of(spark, range(5000, 5040)), out, "b=2")
    for b, part in enumerate(parts):
        put(part, out, f"b={b}")
    every = parts[0].unionByName(parts[2]).unionByName(parts[3])
    wanted = reports.overview(every)
    assert overview_merged(spark, out).select(*wanted.columns).collect() == wanted.collect()
    lengths = sorted(r.original_length for r in every.select("original_length").collect())
    found = {r.type: r for r in lengths_merged(spark, out).collect()}
    assert found["Original"].n == 1500 and (found["Original"].min_len, found["Original"].max_len) == (lengths[0], lengths[-1])
    for p, q in zip((0.25, 0.5, 0.75), found["Original"].quantiles):
        below, upto = (sum(f(x, q) for x in lengths) / 1500 for f in (int.__lt__, int.__le__))
        assert below <= p + 0.005 and upto >= p - 0.005


def test_the_error_of_merged_ranks_stays_small(spark, tmp_path):
    """Many values, so that sketches are compacted: 40,000 rows in five batches."""
    out = str(tmp_path / "out")
    for b in range(5):
        put(rows_of(spark, range(8000 * b, 8000 * (b + 1)), seed=b).withColumn("original_length", (F.col("id") * 7919 % 40_009).cast("int")), out, f"b={b}")
    ranks = tuple(p / 20 for p in range(1, 20))
    (row,) = lengths_merged(spark, out, ranks).where("type = 'Original'").collect()
    assert max(abs(q / 40_009 - p) for p, q in zip(ranks, row.quantiles)) < 0.005


def test_nothing_to_merge(spark, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        (row,) = overview_merged(spark, out).collect()
        assert (row.records, row.windows, row.topics_detected, row.avg_original_length) == (0, 0, 0, None)
        assert lengths_merged(spark, out).count() == 0
        put(rows_of(spark, []), out, "b=0")
