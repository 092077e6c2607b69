"""Text lines with their number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesselar.workspace import materialize


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` and ``number`` of every line below ``path``, counted from 0 in file and line order.

    Files follow the number in ``part-<number>``, then their names; names without one come first. The lines are read
    once and written with their split and their place in it; one row per split then tells where each split starts.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        # Consecutive inside one split.
        F.monotonically_increasing_id().alias("row"),
    )
    lines = materialize(lines, "lines")
    splits = lines.groupBy("file", "split").agg(F.min("row").alias("first_row"), F.count("*").alias("split_lines"))
    part = F.regexp_extract("file", r"part-(\d+)[^/]*\z", 1).try_cast("long")
    before = Window.orderBy(part.asc_nulls_first(), "file", "split").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("split_lines").over(before), F.lit(0))
    starts = splits.select("file", "split", (start - F.col("first_row")).alias("shift"))
    return lines.join(starts, ["file", "split"]).select("line", (F.col("row") + F.col("shift")).alias("number"))
