"""Period statistics of metrics, threshold labels, breach counters, alarms."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselar.operators.folds import Fold, chunks_for, fold_in_order, last_place, since
from tesselar.operators.ordered import chunk, finish, plain, running, trailing
from tesselar.operators.skew import ROWS_PER_TASK, find_hot_keys


@dataclass(frozen=True)
class AlarmRule:
    """Average over ``period`` seconds compared strictly with ``threshold``."""

    name: str
    comparison: str
    threshold: float
    period: int
    adjustment: int
    cooldown: int = 120

    def breached(self, average: Column) -> Column:
        if self.comparison == ">":
            # NaN orders above every number but breaches nothing.
            return (average > self.threshold) & ~F.isnan(average)
        return average < self.threshold


# The two alarms of the managed scaling group.
DEFAULT_RULES = (
    AlarmRule("scale_up", ">", 65.0, 180, 1),
    AlarmRule("scale_down", "<", 25.0, 240, -1),
)


def metric_period_stats(metrics: DataFrame, period: int) -> DataFrame:
    """Average and observed duration of every ``period`` seconds of every dimension."""
    micros = lambda column: F.unix_micros(column.cast("timestamp"))
    seconds = (micros(F.max("ts")) - micros(F.min("ts"))) / 1e6
    return (
        metrics.groupBy("dim", F.window("ts", f"{period} seconds").alias("w"))
        .agg(F.avg("value").alias("average"), seconds.alias("duration"))
        .select("dim", F.col("w.start").alias("t"), "average", "duration")
    )


def last_n_avg(stats: DataFrame, n: int = 3, rows_per_chunk: int = ROWS_PER_TASK) -> DataFrame:
    """Mean of the averages of the latest up to ``n`` periods, as ``last_avg``; nulls are left out."""
    recent = finish(trailing(chunk(stats, ["dim"], ["t"], rows_per_chunk), F.col("average"), n, "_recent"))
    total = F.aggregate("_recent", F.lit(0.0), lambda acc, value: acc + value)
    mean = F.when(F.size("_recent") > 0, total / F.size("_recent"))
    return recent.withColumn("last_avg", mean).drop("_recent")


def threshold_label(
    stats: DataFrame, upper: float, lower: float, value: str = "last_avg"
) -> DataFrame:
    """``up`` at or above ``upper``, else ``down`` at or below ``lower``, else ``neutral``."""
    reading = F.col(value)
    label = (
        F.when(reading.isNull() | F.isnan(reading), "neutral")
        .when(reading >= upper, "up")
        .when(reading <= lower, "down")
        .otherwise("neutral")
    )
    return stats.withColumn("label", label)


class CounterFold(Fold):
    """State: ups and downs since the last neutral reading. Summary: the same, and whether there was a neutral one."""

    start = (0, 0)
    shape = "up LONG, down LONG"

    def _counted(self, rows: pa.Table, first: np.ndarray, state: tuple[int, int]) -> tuple[list[np.ndarray], np.ndarray]:
        label = rows.column("label").combine_chunks()
        marks = {name: pc.fill_null(pc.equal(label, name), False).to_numpy(zero_copy_only=False) for name in ("neutral", "up", "down")}
        reset = last_place(marks["neutral"], first)
        untouched = (first == 0) & (reset < 0)
        counted = []
        for name, before in zip(("up", "down"), state, strict=True):
            counted.append(since(marks[name].astype(np.int64), np.maximum(reset, first)) + np.where(untouched, before, 0))
        return counted, untouched

    def summary(self, rows: pa.Table):
        counted, untouched = self._counted(rows, np.zeros(rows.num_rows, np.int64), self.start)
        return (*(int(count[-1]) for count in counted), not untouched[-1])

    def compose(self, state, summary):
        ups, downs, reset = summary
        return (ups, downs) if reset else (state[0] + ups, state[1] + downs)

    def apply(self, rows: pa.Table, first: np.ndarray, state) -> dict[str, pa.Array]:
        counted = self._counted(rows, first, state)[0]
        return {"up": pa.array(counted[0]), "down": pa.array(counted[1])}


def breach_counters(labelled: DataFrame, rows_per_chunk: int = ROWS_PER_TASK) -> DataFrame:
    """Ups and downs since the last neutral reading; an up does not reset the downs."""
    is_label = lambda name: (F.col("label") == name).cast("long")
    neutral = F.col("label") == "neutral"
    hot = find_hot_keys(labelled, ["dim"], rows_per_chunk)
    if hot:
        chunks = chunks_for(labelled.sparkSession, hot.rows, rows_per_chunk)
        return fold_in_order(labelled, ["dim"], ["t"], CounterFold(), chunks)
    counted = running(
        plain(labelled, ["dim"], ["t"]),
        sums={"_ups": is_label("up"), "_downs": is_label("down")},
    )
    based = running(
        counted,
        maxima={
            "_ups_before": F.when(neutral, F.col("_ups")),
            "_downs_before": F.when(neutral, F.col("_downs")),
        },
    )
    left = lambda name: F.col(name) - F.coalesce(F.col(f"{name}_before"), F.lit(0))
    result = finish(based).withColumns({"up": left("_ups"), "down": left("_downs")})
    return result.drop("_ups", "_downs", "_ups_before", "_downs_before")


def tumbling_alarm(metrics: DataFrame, rules: Sequence[AlarmRule] = DEFAULT_RULES) -> DataFrame:
    """One row per rule, dimension and period whose average breaches the rule.

    The readings are summed once to the common divisor of the periods; the rules roll up from there.
    """
    cell = reduce(math.gcd, [rule.period for rule in rules])
    cells = (
        metrics.groupBy("dim", F.window("ts", f"{cell} seconds").alias("w"))
        .agg(F.sum("value").alias("total"), F.count("value").alias("readings"))
        .select("dim", F.col("w.start").alias("cell"), "total", "readings")
    )

    def alarms(rule: AlarmRule) -> DataFrame:
        average = F.sum("total") / F.sum("readings")
        averages = (
            cells.groupBy("dim", F.window("cell", f"{rule.period} seconds").alias("w"))
            .agg(average.alias("average"))
            .select("dim", F.col("w.start").alias("t"), "average")
        )
        return averages.filter(rule.breached(F.col("average"))).select(
            F.lit(rule.name).alias("rule"), "dim", "t", "average", F.lit(rule.adjustment).alias("adjustment")
        )

    return reduce(DataFrame.unionAll, [alarms(rule) for rule in rules])
