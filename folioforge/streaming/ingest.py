"""Documents as they arrive: a file is a document, so a micro-batch never splits one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioforge.operators.components import components
from folioforge.sources.files import file_name

FILES = "path string, modificationTime timestamp, length long, content binary"


def arriving_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of ``source, markdown``."""
    found = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.md").load(folder)
    return found.select(file_name(F.col("path")).alias("source"), F.col("content").cast("string").alias("markdown"))


def stream_components(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of components; parsing is stateless, so it runs on the stream itself."""
    return components(arriving_markdown(spark, folder))


def for_each_batch(stream: DataFrame, f: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Write ``f`` of each batch, for operators that need windows or joins inside a document.

    A batch has a folder of its own and is overwritten if it is repeated, so results are written exactly once.
    """
    return stream.writeStream.foreachBatch(lambda df, n: f(df).write.mode("overwrite").parquet(f"{path}/batch={n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
