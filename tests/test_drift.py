import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicwake.functions.scalars import drift_magnitude, js_distance
from topicwake.operators import drift


def brute_force(rows, k, window, threshold):
    """The detector as a plain loop: (row results, window results)."""
    current, previous, number, out, windows = [], None, 0, {}, []
    for i, topic in sorted(rows):
        result = (number, False, 0.0, "none")
        if topic is not None and topic >= 0:
            current.append(topic)
            if len(current) == window:
                counts = np.array([current.count(t) for t in range(k)])
                dist = (counts + 1e-10) / (window + k * 1e-10)
                if previous is not None:
                    p, q = previous / previous.sum(), dist / dist.sum()
                    m = (p + q) / 2
                    js = math.sqrt(max(0, (p * np.log(p / m) + q * np.log(q / m)).sum() / 2))
                    size = "none" if js < 0.05 else "low" if js < 0.1 else "medium" if js < 0.2 else "high"
                    result = (number, js > threshold, round(js, 4), size)
                windows.append(result)
                previous, current, number = dist, [], number + 1
        out[i] = result
    return out, windows


def run(spark, rows, k, window, dense=False):
    df = spark.createDataFrame(rows, "id long, dominant_topic int").repartition(4)
    windowed = drift.count_windows(df, window=window, dense=dense)
    windows = drift.drift_windows(windowed, k=k, window=window)
    attached = drift.attach_drift(windowed, windows)
    per_row = {r.id: (r.window_id, r.drift_detected, r.js_divergence, r.drift_magnitude) for r in attached.collect()}
    split = drift.attach_drift(windowed, windows, written=True)
    assert {r.id: (r.window_id, r.drift_detected, r.js_divergence, r.drift_magnitude) for r in split.collect()} == per_row
    table = [
        (r.window_id, r.drift_detected, r.js_divergence, r.drift_magnitude)
        for r in windows.orderBy("window_id").collect()
    ]
    return per_row, table


def test_known_windows(spark):
    rows = list(enumerate([0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 1, 1, 2, 2]))
    per_row, table = run(spark, rows, 3, 4)
    assert table == [(0, False, 0.0, "none"), (1, False, 0.0, "none"), (2, True, 0.8326, "high")]
    assert per_row[11] == (2, True, 0.8326, "high") and per_row[10] == (2, False, 0.0, "none")
    assert per_row[12][0] == per_row[13][0] == 3


def test_rows_without_topic_carry_the_current_window(spark):
    per_row, _ = run(spark, list(enumerate([0, -1, 0, -1, 1])), 3, 2)
    assert [per_row[i][0] for i in range(5)] == [0, 0, 0, 1, 1]
    df = spark.createDataFrame(list(enumerate([0, -1, 0, -1, 1])), "id long, dominant_topic int")
    closing = drift.count_windows(df, window=2).where("is_closing").collect()
    assert [r.id for r in closing] == [2]


@pytest.mark.parametrize("window", [1, 7, 50])
def test_against_a_plain_loop(spark, window):
    rng = random.Random(window)
    rows = [(i * 3 + rng.randrange(3), rng.choice([-1, None, 0, 0, 1, 2, 3, 9])) for i in range(900)]
    per_row, table = run(spark, rows, 10, window)
    wanted_rows, wanted_table = brute_force(rows, 10, window, 0.15)
    assert per_row == wanted_rows
    assert table == wanted_table


def test_dense_ids_need_no_running_count(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(4)) for i in range(500)]
    assert run(spark, rows, 4, 20, dense=True) == run(spark, rows, 4, 20)
    df = spark.createDataFrame(rows, "id long, dominant_topic int")
    assert "Exchange" not in drift.count_windows(df, dense=True)._jdf.queryExecution().executedPlan().toString()


def test_windows_beyond_one_block_find_their_predecessor(spark):
    ids = [0, 1, 65534, 65535, 65536, 65537, 131071, 131072, 200000]
    df = spark.createDataFrame([(i, [float(i)]) for i in ids], "window_id long, dist array<double>")
    got = {r.window_id: r.previous_dist for r in drift.adjacent_windows(df).collect()}
    assert got == {i: [float(i - 1)] if i - 1 in ids else None for i in ids}


def test_thresholds(spark):
    edges = spark.createDataFrame([(v,) for v in (0.0499, 0.05, 0.0999, 0.10, 0.15, 0.1999, 0.20)], "js double")
    got = [r[0] for r in edges.select(drift_magnitude(F.col("js"))).collect()]
    assert got == ["none", "low", "low", "medium", "medium", "medium", "high"]
    # the flag is strict and on the exact distance
    pair = spark.createDataFrame([(1, 5, [0.5, 0.5], [0.9, 0.1])], "window_id long, closing_id long, dist array<double>, previous_dist array<double>")
    js = pair.select(js_distance(F.col("previous_dist"), F.col("dist"))).first()[0]
    assert not drift.judge_windows(pair, js).first().drift_detected
    assert drift.judge_windows(pair, js - 1e-9).first().drift_detected


def test_distance_is_symmetric_and_bounded(spark):
    rng = random.Random(3)
    rows = [([rng.random() for _ in range(6)], [rng.random() * (j > 2) for j in range(6)]) for _ in range(50)]
    rows.append(([1.0, 0.0], [0.0, 1.0]))
    df = spark.createDataFrame(rows, "p array<double>, q array<double>")
    for a, b in df.select(js_distance(F.col("p"), F.col("q")), js_distance(F.col("q"), F.col("p"))).collect():
        assert a == pytest.approx(b) and 0 <= a <= math.sqrt(math.log(2)) + 1e-12
    same = spark.createDataFrame([([0.2, 0.8], [0.2, 0.8])], "p array<double>, q array<double>")
    assert same.select(js_distance(F.col("p"), F.col("q"))).first()[0] == 0.0


def test_summary_and_last_events(spark):
    windows = spark.createDataFrame(
        [(i, i, 0.3 if i % 2 else 0.0, bool(i % 2), "high" if i % 2 else "none") for i in range(40)],
        "window_id long, closing_id long, js_divergence double, drift_detected boolean, drift_magnitude string",
    )
    clock = F.timestamp_seconds(F.lit(1704164645))
    summary = drift.drift_summary(windows, clock=clock).first()
    assert summary[:2] == (40, 20) and [e.window_id for e in summary.drift_events] == list(range(21, 41, 2))
    assert tuple(summary.drift_events[0]) == (21, 0.3, "high", "2024-01-02T03:04:05.000000")
    assert [r.window_id for r in drift.last_drift_events(windows).collect()] == list(range(21, 41, 2))
    assert drift.drift_summary(windows.where("window_id < 0")).first().asDict() == {
        "total_windows": 0, "drift_events_count": 0, "drift_events": [],
    }


def test_a_gap_in_dense_ids_loses_no_row(spark):
    df = spark.createDataFrame([(i, 0) for i in range(12) if i != 7], "id long, dominant_topic int")
    windowed = drift.count_windows(df, window=4, dense=True)
    windows = drift.drift_windows(windowed, window=4)
    assert drift.attach_drift(windowed, windows, written=True).count() == 11
