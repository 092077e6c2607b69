"""Health of instances from their probes. A probe is ok when its status is 200."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.operators.folds import Fold, chunks_for, fold_in_order, last_place
from tesselar.operators.ordered import chunk, finish, plain, running
from tesselar.operators.skew import ROWS_PER_TASK, find_hot_keys


def _ok():
    return F.coalesce(F.col("status") == 200, F.lit(False))


class HealthFold(Fold):
    """State: (oks in a row, failures in a row, health). Summary: the same for rows entered from the start, the rows
    of the first run, whether these are all and whether they are oks."""

    start = (0, 0, "unknown")
    shape = "state STRING"

    def __init__(self, up: int, down: int):
        self.up, self.down = up, down

    def _folded(self, ok: np.ndarray, first: np.ndarray, state: tuple[int, int, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Oks in a row, failures in a row and health (as a number) after every row."""
        here = np.arange(len(ok))
        oks, fails = here - last_place(~ok, first), here - last_place(ok, first)
        entered = first == 0
        oks += np.where(entered & (oks == here + 1), state[0], 0)
        fails += np.where(entered & (fails == here + 1), state[1], 0)
        flips = np.where(ok & (oks >= self.up), 1, np.where(~ok & (fails >= self.down), 2, 0))
        at = last_place(flips > 0, first)
        health = np.where(at >= first, flips[at], np.where(entered, HEALTH.index(state[2]), 0))
        return oks, fails, health

    def summary(self, rows: pa.Table):
        ok = rows.column("_ok").to_numpy()
        oks, fails, health = self._folded(ok, np.zeros(len(ok), np.int64), self.start)
        change = np.flatnonzero(ok != ok[0])
        run = int(change[0]) if len(change) else len(ok)
        return int(oks[-1]), int(fails[-1]), HEALTH[health[-1]], run, run == len(ok), bool(ok[0])

    def compose(self, state, summary):
        oks, fails, health, run, all_of_it, first_ok = summary
        if health == "unknown":
            # No flip from the start: only the first run can flip, with the run before it.
            before, least, name = (state[0], self.up, "healthy") if first_ok else (state[1], self.down, "unhealthy")
            health = name if before + run >= least else state[2]
        if all_of_it:
            oks, fails = (oks + state[0], 0) if first_ok else (0, fails + state[1])
        return oks, fails, health

    def apply(self, rows: pa.Table, first: np.ndarray, state) -> dict[str, pa.Array]:
        health = self._folded(rows.column("_ok").to_numpy(), first, state)[2]
        return {"state": pa.array(np.array(HEALTH, object)[health], pa.string())}


HEALTH = ("unknown", "healthy", "unhealthy")


def health_state(
    probes: DataFrame, up: int = 3, down: int = 5, rows_per_chunk: int = ROWS_PER_TASK
) -> DataFrame:
    """State after every probe: ``healthy`` after ``up`` oks in a row, ``unhealthy`` after ``down``
    failures in a row, else as before; ``unknown`` at first."""
    ok = _ok()
    hot = find_hot_keys(probes, ["instance"], rows_per_chunk)
    if hot:
        marked = probes.withColumn("_ok", ok)
        chunks = chunks_for(probes.sparkSession, hot.rows, rows_per_chunk)
        folded = fold_in_order(marked, ["instance"], ["ts", "seq"], HealthFold(up, down), chunks)
        return folded.select(*probes.columns, "state")
    counted = running(
        plain(probes, ["instance"], ["ts", "seq"]),
        sums={"_oks": ok.cast("long"), "_fails": (~ok).cast("long")},
    )
    based = running(
        counted,
        maxima={
            "_oks_before": F.when(~ok, F.col("_oks")),
            "_fails_before": F.when(ok, F.col("_fails")),
        },
    )
    run = lambda name: F.col(name) - F.coalesce(F.col(f"{name}_before"), F.lit(0))
    position = F.col("_oks") + F.col("_fails")
    flipped = running(
        based,
        maxima={
            "_healthy_at": F.when(ok & (run("_oks") >= up), position),
            "_unhealthy_at": F.when(~ok & (run("_fails") >= down), position),
        },
    )
    healthy_at = F.coalesce(F.col("_healthy_at"), F.lit(0))
    unhealthy_at = F.coalesce(F.col("_unhealthy_at"), F.lit(0))
    state = (
        F.when(healthy_at > unhealthy_at, "healthy")
        .when(unhealthy_at > healthy_at, "unhealthy")
        .otherwise("unknown")
    )
    return finish(flipped).select(*probes.columns, state.alias("state"))


def evict_first_failure(
    probes: DataFrame, adds: DataFrame, rows_per_chunk: int = ROWS_PER_TASK
) -> DataFrame:
    """List entries: every add leaves the list at the first failed probe of its instance at or after it.

    ``adds`` is ``(ts, instance)``; an add comes before a probe of the same time, and adds of one instance
    are entries of their own (``episode`` counts them). ``evicted_at`` is null while the entry is still on
    the list.
    """
    is_add = F.col("kind") == 0
    history = probes.select("instance", "ts", F.lit(1).alias("kind"), (~_ok()).alias("failed")).unionAll(
        adds.select("instance", "ts", F.lit(0).alias("kind"), F.lit(False).alias("failed"))
    )
    chunked = chunk(history, ["instance"], ["ts", "kind"], rows_per_chunk)
    counted = finish(
        running(chunked, sums={"episode": is_add.cast("long"), "fails": F.col("failed").cast("long")})
    )
    # An entry after k failures leaves at failure k + 1.
    failures = counted.filter("failed").select(
        "instance", (F.col("fails") - 1).alias("fails"), F.col("ts").alias("evicted_at")
    )
    entries = counted.filter(is_add).select("instance", "fails", "episode", F.col("ts").alias("added_at"))
    left = entries.join(failures, ["instance", "fails"], "left")
    return left.select("instance", "episode", "added_at", "evicted_at")
