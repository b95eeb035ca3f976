import pytest
from pyspark.sql import functions as F

from topicwake.plans import reports
from topicwake.sources.page_index import build_page_index, count_rows, read_page, read_range


@pytest.fixture(scope="module")
def stage(spark, tmp_path_factory):
    """300,000 rows whose ids have gaps, in no order; (path, rows)."""
    path = str(tmp_path_factory.mktemp("index"))
    rows = spark.range(300_000).select((F.col("id") * 7 % 300_007 * 3).alias("id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    build_page_index(rows, path, partitions=3)
    return path, rows


def test_pages_are_those_of_a_sort(spark, stage):
    path, rows = stage
    ordered = [tuple(r) for r in rows.orderBy("id").collect()]
    assert count_rows(spark, path) == 300_000
    for number, size in ((1, 10), (3, 10), (6554, 10), (10_001, 10), (30_000, 10), (3, 70_000), (30_001, 10), (5, 70_000)):
        found = read_page(spark, path, rows.schema, number, size)
        assert [tuple(r) for r in found.collect()] == ordered[size * (number - 1) : size * number]
    few = reports.page(rows.where("id < 3000"), 4)
    assert [r.id for r in few.collect()] == [r.id for r in read_page(spark, path, rows.schema, 4).collect()]


def test_a_page_reads_a_few_pages_of_one_file(spark, stage):
    path, rows = stage
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for start in (5, 99_990, 150_000, 299_995):
            page = read_range(spark, path, rows.schema, start, 10)
            assert len(page.collect()) == min(10, 300_000 - start)
            leaf = page._jdf.queryExecution().executedPlan().collectLeaves().head()
            assert leaf.metrics().get("numOutputRows").get().value() <= 4000
            assert leaf.metrics().get("numFiles").get().value() <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_null_and_equal_ids_and_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (None, "n"), (1, "a"), (2, "c"), (None, "m")], "id long, text string")
    build_page_index(rows, str(tmp_path / "a"), partitions=4)
    pages = [read_page(spark, str(tmp_path / "a"), rows.schema, p, 2).collect() for p in (1, 2, 3, 4)]
    assert [[r.id for r in p] for p in pages] == [[None, None], [1, 2], [2], []] and {r.text for p in pages for r in p} == set("abcmn")
    build_page_index(rows.limit(0), str(tmp_path / "b"))
    assert read_page(spark, str(tmp_path / "b"), rows.schema, 1).count() == 0 and count_rows(spark, str(tmp_path / "b")) == 0
