"""Documents as files: one file each, by the executors, or partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import strip_extension


def write_text_files(df: DataFrame, path: str, name: str, text: str, extension: str) -> None:
    """One UTF-8 file for each row, in a folder named after it; Spark's writer makes it safe to repeat a task."""
    out = df.select(strip_extension(F.col(name)).alias("document"), F.col(text).alias("value"))
    out.repartition("document").write.mode("overwrite").partitionBy("document").option("lineSep", "\n").format("text").option("fileExtension", extension).save(path)


def write_json_lines(components: DataFrame, path: str) -> None:
    """A line for each component."""
    components.write.mode("overwrite").json(path)


def grid_json(df: DataFrame, width: str = "width", height: str = "height", grid: str = "grid") -> DataFrame:
    return df.withColumn("json", F.to_json(F.struct(F.col(width).alias("width"), F.col(height).alias("height"), F.col(grid).alias("grid"))))
