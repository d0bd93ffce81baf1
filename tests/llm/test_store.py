import time

from pyspark.sql import functions as F

from folioforge.llm.store import Scratch


def test_shuffle_files_of_the_last_table_are_freed(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString(" ").split() if "shuffle_" in f}
    scratch = Scratch(spark, "test")
    before = files()
    scratch.save(spark.range(100_000).groupBy(F.xxhash64("id").alias("h")).count())
    mine = files() - before
    scratch.drop()
    for _ in range(50):
        if not mine & files():
            break
        time.sleep(0.1)
    assert mine and not mine & files()
