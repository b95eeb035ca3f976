import time

from pyspark.sql import functions as F

from topicwake.session import materialize

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def test_a_written_table_leaves_no_shuffle_files(spark):
    """They go as the write ends, with no garbage collection, and the setting is as it was."""
    before, setting = shuffle_bytes(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(200_000).withColumn("h", F.xxhash64("id")).repartition(4, "h").groupBy("h").agg(F.max("id").alias("m"))
    table = materialize(rows, "rows")
    end = time.time() + 20
    while shuffle_bytes(spark) > before and time.time() < end:
        time.sleep(0.2)
    assert shuffle_bytes(spark) <= before
    assert table.count() == rows.count() == 200_000 and spark.conf.get(CLEANUP, None) == setting
