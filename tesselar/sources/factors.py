"""Factor files: one line of comma-joined values per row, the row position is the id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselar.functions.vectors import joined_values
from tesselar.sources.lines import numbered_lines


def factor_lines(factors: DataFrame, digits: int | None = None) -> DataFrame:
    return factors.select("role", "id", joined_values(F.col("vec"), digits).alias("line"))


def write_factors_csv(
    factors: DataFrame, path: str, role: str, single_file: bool = False, digits: int | None = None
) -> None:
    """Write the lines of one role in id order.

    The part files follow the id order by name; ``single_file`` funnels them through one task and
    suits small models only.
    """
    lines = factor_lines(factors.filter(F.col("role") == role), digits).orderBy("id").select("line")
    (lines.coalesce(1) if single_file else lines).write.text(path)


def read_factors_csv(spark: SparkSession, path: str, role: str) -> DataFrame:
    """Read the lines back; ids count from 0 in file and line order, see ``numbered_lines``."""
    return numbered_lines(spark, path).select(
        F.lit(role).alias("role"),
        F.col("number").alias("id"),
        F.transform(F.split("line", ","), lambda token: token.cast("double")).alias("vec"),
    )
