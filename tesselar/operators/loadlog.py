"""Load-test logs and responses."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesselar.functions.text import SUCCESS_PHRASE, log_name
from tesselar.operators.folds import Fold, chunks_for, fold_in_order, last_place
from tesselar.operators.skew import ROWS_PER_TASK, find_hot_keys

# Line starts in the load generator's log.
HEADER = "[Min"
READING = "ec2"
LOAD_TARGET = 4000.0


def log_id_extract(responses: DataFrame) -> DataFrame:
    return responses.select("id", log_name(F.col("text")).alias("log_name"))


def text_contains_flag(responses: DataFrame, phrase: str = SUCCESS_PHRASE) -> DataFrame:
    return responses.select("id", F.contains("text", F.lit(phrase)).alias("found"))


class LastMinuteFold(Fold):
    """State: the sum of the readings after the last header so far. Summary: the same, and whether there was a header.

    Adds the sum up to and with every row.
    """

    start = 0.0
    shape = "rps DOUBLE"

    def _sums(self, rows: pa.Table, first: np.ndarray, state: float) -> tuple[np.ndarray, np.ndarray]:
        value, header = rows.column("value").to_numpy(), rows.column("header").to_numpy()
        reset = last_place(header, first)
        untouched = (first == 0) & (reset < 0)
        begin = np.maximum(reset, first)
        # Summed up from every header anew, so that no sum depends on the readings before it.
        sums = np.empty(len(value))
        for start, end in pairwise([*np.flatnonzero(np.diff(begin, prepend=-1)).tolist(), len(value)]):
            sums[start:end] = np.cumsum(value[start:end])
        return sums + np.where(untouched, state, 0.0), untouched

    def summary(self, rows: pa.Table):
        sums, untouched = self._sums(rows, np.zeros(rows.num_rows, np.int64), self.start)
        return float(sums[-1]), not untouched[-1]

    def compose(self, state, summary):
        total, reset = summary
        return total if reset else state + total

    def apply(self, rows: pa.Table, first: np.ndarray, state) -> dict[str, pa.Array]:
        return {"rps": pa.array(self._sums(rows, first, state)[0])}


def last_minute_rps(log: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Sum of the readings after the last header of every run; of all its readings without one.

    Lines that are neither headers nor readings stay out of the order; a run of such lines only has the sum 0.
    """
    hot = find_hot_keys(log, ["run_id"], rows_per_task)
    is_header, is_reading = (F.startswith("line", F.lit(mark)) for mark in (HEADER, READING))
    value = F.when(is_reading, F.split("line", "=").getItem(1).cast("double"))
    if not hot:
        # Every run fits a task: the last header by the whole run, then one sum.
        header = F.max(F.when(is_header, F.col("seq"))).over(Window.partitionBy("run_id"))
        last = log.withColumn("_header", header).withColumn("_value", value)
        counted = F.col("_header").isNull() | (F.col("seq") > F.col("_header"))
        sums = last.groupBy("run_id").agg(F.sum(F.when(counted, F.col("_value"))).alias("rps"))
        return sums.fillna(0.0, ["rps"])
    marked = log.select("run_id", "seq", is_header.alias("header"), F.coalesce(value, F.lit(0.0)).alias("value"))
    chunks = chunks_for(log.sparkSession, hot.rows, rows_per_task)
    folded = fold_in_order(marked, ["run_id"], ["seq"], LastMinuteFold(), chunks)
    return folded.groupBy("run_id").agg(F.max_by("rps", "seq").alias("rps"))


def first_reach(steps: DataFrame, threshold: float = LOAD_TARGET) -> DataFrame:
    """First step of every run whose load reaches the threshold, and the steps used up to it."""
    reached = F.min(F.when(F.col("load") >= threshold, F.col("step")))
    firsts = steps.groupBy("run_id").agg(
        reached.alias("first_step"), F.min("step").alias("_start")
    )
    used = F.col("first_step") - F.col("_start") + 1
    return firsts.filter(F.col("first_step").isNotNull()).select(
        "run_id", "first_step", used.alias("steps_used")
    )
