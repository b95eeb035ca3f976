import random

from pyspark.sql import functions as F

from topicwake.operators.ids import dense_id, rows_before


def test_rows_before_with_scattered_ids(spark):
    rng = random.Random(1)
    ids = {rng.randrange(1 << bits) for bits in (5, 21, 22, 40, 41, 62) for _ in range(60)}
    rows = [(i, rng.random() < 0.6) for i in ids]
    df = spark.createDataFrame(rows, "id long, hit boolean").repartition(5)
    got = {r.id: r.before for r in rows_before(df, "id", F.col("hit")).collect()}
    seen, wanted = 0, {}
    for i, hit in sorted(rows):
        wanted[i] = seen
        seen += hit
    assert got == wanted


def test_rows_before_counts_all_by_default_and_keeps_columns(spark):
    df = spark.createDataFrame([(7, "a"), (3, "b"), (5, "c")], "id long, v string")
    got = rows_before(df, "id")
    assert got.columns == ["id", "v", "before"]
    assert {r.id: r.before for r in got.collect()} == {3: 0, 5: 1, 7: 2}


def test_rows_before_has_one_bounded_global_step(spark):
    df = spark.range(100)
    plan = rows_before(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1


def test_only_ids_and_flags_move_to_the_bucket(spark, tmp_path):
    spark.range(50).selectExpr("id", "repeat('x', 100) as text", "id % 2 as hit").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    lines = rows_before(df, "id", F.col("hit") == 1)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = [i for i, line in enumerate(lines) if "Window" in line and "_hit" in line]
    assert at
    for i in at:
        below = [x for x in lines[i + 1 :]]
        end = next((k for k, x in enumerate(below) if depth(x) <= depth(lines[i])), len(below))
        assert not any("text" in x for x in below[:end] if "Relation" not in x)


def test_dense_id_splits_a_hot_leading_key(spark):
    rows = [(1, i) for i in range(400)] + [(0, 3), (2, 1), (2, 0)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "a long, b long")
    got = dense_id(df, ["a", "b"], partitions=6).orderBy("id").collect()
    assert [(r.a, r.b) for r in got] == sorted(rows)
    assert [r.id for r in got] == list(range(len(rows)))
