"""Text logs as lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_log(runs: DataFrame) -> DataFrame:
    """``(run_id, text)`` to ``(run_id, seq, line)``; what follows the last newline is left out."""
    lines = F.split(F.col("text"), "\n", -1)
    complete = F.slice(lines, F.lit(1), F.size(lines) - 1)
    return runs.select("run_id", F.posexplode(complete).alias("seq", "line")).select(
        "run_id", F.col("seq").cast("long").alias("seq"), "line"
    )
