"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one is set only where none is configured and all runs on one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        kept = spark.sparkContext.getCheckpointDir()
        if kept:
            return kept
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="folioforge-")
        spark.sparkContext.setCheckpointDir(path)
    return path


class Scratch:
    """Tables written to the shared folder, so that lineage is short and lost executors cost little."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}

    def save(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        """Write ``df`` and read it back."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            path = getattr(t, "_scratch_path", None)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)
        self.spark.sparkContext.parallelize([0], 1).count()  # until another job has run, Spark holds on to the last one
        gc.collect()
        jvm.System.gc()  # so that Spark's cleaner drops the shuffle files that led to them


def bounded_sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest values of a 64-bit hash; all rows where there are no more.

    A bound on the hash leaves about twice as many rows before they are sorted, so that what meets in one
    task is bounded however many tasks the rows come from.
    """
    total = df.count()
    if total > 2 * n:
        df = df.where(key < int(2 * n / total * 2.0**64) - 2**63)
    return df.orderBy(key).limit(n)
