"""Streaming form of the scaling decisions.

Readings are averaged per period by the built-in windowed aggregation, which combines before the
shuffle; only closed periods, one row per dimension and period, reach the state machine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tesselar.operators.scaling import CounterMachine, ScalingParams
from tesselar.streaming.alarms import period_averages

# The latest periods: their averages, and which of them have none or are not a number.
STATE_SCHEMA = (
    "up INT, down INT, size INT, resume LONG, recent ARRAY<DOUBLE>, empty ARRAY<BOOLEAN>, nan ARRAY<BOOLEAN>"
)
OUTPUT_SCHEMA = (
    "dim STRING, t TIMESTAMP, t_end TIMESTAMP, last_avg DOUBLE, label STRING, size LONG, action LONG, "
    "poisoned BOOLEAN"
)


class DecisionProcessor(StatefulProcessor):
    """Keeps the machine state and the latest averages of a dimension between batches."""

    def __init__(self, params: ScalingParams, n: int):
        self.params, self.n = params, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.machine = CounterMachine(self.params)
        self.state = handle.getValueState("decision", STATE_SCHEMA)

    def label(self, reading: float) -> str:
        if math.isnan(reading):
            return "neutral"
        if reading >= self.params.upper:
            return "up"
        return "down" if reading <= self.params.lower else "neutral"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state, recent = self.machine.start, []
        if self.state.exists():
            *stored, values, empty, nan = self.state.get()
            state, recent = tuple(int(value) for value in stored), list(zip(values, empty, nan))
        periods = pd.concat(list(rows)).sort_values("t")
        results = []
        for row in periods.itertuples():
            nan = bool(row.is_nan) and not row.is_empty
            known = not row.is_empty and not nan
            recent = [*recent, (float(row.average) if known else 0.0, bool(row.is_empty), nan)][-self.n :]
            # As avg() over the last rows: a missing average is left out, one that is no number spoils it.
            poisoned = any(spoils for _, _, spoils in recent)
            used = [value for value, missing, _ in recent if not missing]
            last_avg = sum(used) / len(used) if used and not poisoned else math.nan
            label = self.label(last_avg)
            micros = row.t.value // 1000
            state, action = self.machine.step(state, micros, label)
            results.append((key[0], row.t, row.t_end, last_avg, label, state[2], action, poisoned))
        self.state.update((*state, *map(list, zip(*recent))))
        names = ["dim", "t", "t_end", "last_avg", "label", "size", "action", "poisoned"]
        yield pd.DataFrame(results, columns=names)

    def close(self) -> None:
        pass


def stream_scaling_decisions(
    stream: DataFrame, params: ScalingParams = ScalingParams(), n: int = 3, delay: str = "10 minutes"
) -> DataFrame:
    """Label, size and action of every closed period, for append mode.

    Needs the RocksDB state store, see ``run_available``.
    """
    # pandas has one mark for both, so the kinds of missing averages are told apart before.
    periods = period_averages(stream, params.period, delay).withColumns(
        {"is_empty": F.col("average").isNull(), "is_nan": F.coalesce(F.isnan("average"), F.lit(False))}
    )
    decided = periods.groupBy("dim").transformWithStateInPandas(
        statefulProcessor=DecisionProcessor(params, n),
        outputStructType=OUTPUT_SCHEMA,
        outputMode="append",
        timeMode="EventTime",
        eventTimeColumnName="t_end",
    )
    last_avg = F.when(F.col("poisoned"), F.lit(float("nan"))).otherwise(F.col("last_avg"))
    return decided.withColumn("last_avg", last_avg).drop("poisoned")
