import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicwake.operators import outcomes

FIELDS = T.StructType().add("id", "long").add("text", "string").add("score", "string")
LINES = [
    '{"id": 1, "text": "a bc", "score": "0.5"}', "{broken", '{"id": 2, "text": "x", "score": "much"}', '{"id": 3, "text": "", "score": "1"}',
    '{"id": 4, "text": null, "score": null}', None, '{"id": "no", "text": "x"}', '{"id": 5, "text": "too long for the check", "score": "2"}',
]


def steps():
    def words(texts):
        return pa.array([1 / len(t.split()) for t in texts.to_pylist()], pa.float64())

    return [
        outcomes.decode("decode", "value", FIELDS),
        outcomes.cast("cast", "score", "double"),
        outcomes.check("check", F.when(F.length("text") > 10, F.lit("long"))),
        outcomes.apply_arrow("score", "share", words, ["text"], "double"),
        outcomes.derive("double", {"twice": F.col("share") * 2}, F.when(F.col("share") * 2 < 1.5, F.lit("small"))),
    ]


def test_each_row_ends_once_with_its_first_failure(spark, tmp_path):
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)], "n int, value string").repartition(2)
    done = outcomes.run_steps(lines, steps())
    good, dead = outcomes.write_outcomes(done, str(tmp_path / "out"), ["id", "score", "twice"], ["n", "value"])
    assert [tuple(r) for r in good.collect()] == []
    found = {r.n: (r.step, r.reason) for r in dead.collect()}
    assert found == {
        0: ("double", "small"), 1: ("decode", "no JSON object of the stage"), 2: ("cast", "score is no double: much"), 3: ("score", "ZeroDivisionError: division by zero"),
        4: ("score", "AttributeError: 'NoneType' object has no attribute 'split'"), 5: ("decode", "no JSON object of the stage"),
        6: ("decode", "no JSON object of the stage"), 7: ("check", "long"),
    }
    assert {r.n: r.value for r in dead.collect()} == dict(enumerate(LINES))
    good, dead = outcomes.write_outcomes(outcomes.run_steps(lines, steps()[:4]), str(tmp_path / "two"), ["id", "score", "share"], ["n"])
    assert [tuple(r) for r in good.collect()] == [(1, 0.5, 0.5)] and dead.count() == 7


def test_the_source_is_read_once(spark, tmp_path):
    spark.createDataFrame([(i, LINES[i % 8]) for i in range(200)], "n int, value string").write.parquet(str(tmp_path / "in"))
    done = outcomes.run_steps(spark.read.parquet(str(tmp_path / "in")), steps())
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("once", "one write")
    try:
        good, dead = outcomes.write_outcomes(done, str(tmp_path / "out"), ["id"], ["n"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("once")) == 1
    assert good.count() + dead.count() == 200


def test_rows_that_fail_do_not_fail_their_batch():
    calls = []

    def inverse(x):
        calls.append(len(x))
        return pa.array([1 / v for v in x.to_pylist()])

    found = outcomes.guarded(inverse, pa.float64())(pa.array([1, 2, 0, 4] + [8] * 60)).to_pylist()
    assert [r["value"] for r in found] == [1, 0.5, None, 0.25] + [0.125] * 60
    assert [r["error"] for r in found if r["error"]] == ["ZeroDivisionError: division by zero"] and len(calls) == 13
    assert outcomes.guarded(inverse, pa.float64())(pa.array([], pa.int64())).to_pylist() == []
    short = outcomes.guarded(lambda x: x.slice(1), pa.int64())(pa.array([1, 2])).to_pylist()
    assert [r["error"] for r in short] == ["RuntimeError: 1 rows gave 0"] * 2

    def full(x):
        raise MemoryError

    with pytest.raises(MemoryError):
        outcomes.guarded(full, pa.int64())(pa.array([1, 2]))


def test_failures_of_a_stream(spark, tmp_path):
    spark.createDataFrame([(x,) for x in LINES if x], "value string").write.text(str(tmp_path / "in"))
    stream = spark.readStream.text(str(tmp_path / "in"))
    kept = []

    def work(batch, n):
        good, dead = outcomes.write_outcomes(outcomes.run_steps(batch, steps()[:2]), f"{tmp_path}/out/batch_id={n}", ["id"], ["value"])
        kept.append((good.count(), dead.count()))

    writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(work)
    writer.trigger(availableNow=True).start().awaitTermination()
    assert kept == [(4, 3)]
