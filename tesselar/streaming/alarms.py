"""Streaming form of the metric alarms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.operators.alarms import DEFAULT_RULES, AlarmRule


def period_averages(stream: DataFrame, period: int, delay: str) -> DataFrame:
    """Average of every closed period; ``t_end`` carries the event time on."""
    return (
        stream.withWatermark("ts", delay)
        .groupBy("dim", F.window("ts", f"{period} seconds").alias("w"))
        .agg(F.avg("value").alias("average"))
        .select("dim", F.col("w.start").alias("t"), F.window_time("w").alias("t_end"), "average")
    )


def stream_metric_alarm(
    stream: DataFrame, rules: Sequence[AlarmRule] = DEFAULT_RULES, delay: str = "10 minutes"
) -> DataFrame:
    """Alarms of closed periods, for append mode. Readings later than ``delay`` are dropped."""

    def alarms(rule: AlarmRule) -> DataFrame:
        averages = period_averages(stream, rule.period, delay)
        return averages.filter(rule.breached(F.col("average"))).select(
            F.lit(rule.name).alias("rule"), "dim", "t", "average", F.lit(rule.adjustment).alias("adjustment")
        )

    return reduce(DataFrame.union, [alarms(rule) for rule in rules])
