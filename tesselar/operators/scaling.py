"""Scaling decisions: state machines folded over each dimension's readings in time order.

A dimension with few readings is folded in one task. A hot one is cut into chunks of time. A chunk
can be entered in few ways: the untimed part of the state takes few values, and a pause set
before the chunk ends before some reading of its head or outlasts it. So all chunks are first
folded from every possible entry in parallel, then the entries are chained from chunk to chunk on
those small tables, and at last every chunk is folded from its real entry.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.operators.alarms import DEFAULT_RULES, AlarmRule
from tesselar.operators.ordered import CHUNK, chunk
from tesselar.operators.skew import null_safe_join

ROWS_PER_FOLD = 500_000
NO_PAUSE = -(2**62)
OUTLASTS = 2**62
MICROS = 1_000_000


@dataclass(frozen=True)
class ScalingParams:
    """The defaults of the metric-driven scaling service."""

    upper: float = 50.0
    lower: float = 30.0
    min_size: int = 1
    max_size: int = 2
    period: int = 5
    count: int = 2
    cooldown: int = 60
    delta: int = 1


@dataclass(frozen=True)
class PolicyParams:
    """The size limits of the managed scaling group."""

    min_size: int = 2
    max_size: int = 4
    rules: Sequence[AlarmRule] = DEFAULT_RULES


class CounterMachine:
    """State (up, down, size, resume). Counters stop at ``count``, more makes no difference."""

    def __init__(self, params: ScalingParams):
        self.params = params
        counters = range(params.count + 1)
        self.untimed = list(
            itertools.product(counters, counters, range(params.min_size, params.max_size + 1))
        )
        self.timers = 1
        self.longest_pause = (params.cooldown + params.period) * MICROS
        self.start = (0, 0, params.min_size, NO_PAUSE)

    def step(self, state: tuple, t: int, label: str) -> tuple[tuple, int]:
        p = self.params
        up, down, size, resume = state
        if t < resume:
            return state, 0
        if label == "up":
            up = min(up + 1, p.count)
        elif label == "down":
            down = min(down + 1, p.count)
        else:
            up = down = 0
        action = 0
        if p.delta > 0:
            if down >= p.count and size > p.min_size:
                action = -1
            elif up >= p.count and size < p.max_size:
                action = 1
        # A larger delta still steps by one and then never pauses.
        if abs(action) == p.delta and down >= p.count:
            resume = t + self.longest_pause
        return (up, down, size + action, resume), action


class PolicyMachine:
    """State (size, one resume time per rule). Only a change of size starts a rule's cooldown."""

    def __init__(self, params: PolicyParams):
        self.params = params
        self.rules = {rule.name: (n, rule) for n, rule in enumerate(params.rules)}
        self.untimed = [(size,) for size in range(params.min_size, params.max_size + 1)]
        self.timers = len(params.rules)
        self.longest_pause = max(rule.cooldown for rule in params.rules) * MICROS
        self.start = (params.min_size, *[NO_PAUSE] * self.timers)

    def step(self, state: tuple, t: int, name: str) -> tuple[tuple, int]:
        position, rule = self.rules[name]
        if t < state[1 + position]:
            return state, 0
        size = min(max(state[0] + rule.adjustment, self.params.min_size), self.params.max_size)
        action = size - state[0]
        if action == 0:
            return state, 0
        resumes = list(state[1:])
        resumes[position] = t + rule.cooldown * MICROS
        return (size, *resumes), action


def _head(machine, times: list[int]) -> tuple[list[int], bool]:
    """Readings that may be the first after a pause set before the chunk, and whether such a
    pause may outlast the chunk."""
    limit = times[0] + machine.longest_pause
    behind = bisect.bisect_left(times, limit)
    return sorted(set(times[: behind + 1]) - {times[0]}), behind == len(times)


def _entries(machine, head: list[int], outlasts: bool) -> list[tuple]:
    """Every way to enter a chunk: pauses are named by the first reading they let through."""
    choices = [NO_PAUSE, *head, *([OUTLASTS] if outlasts else [])]
    return [
        (*untimed, *timers)
        for untimed in machine.untimed
        for timers in itertools.product(choices, repeat=machine.timers)
    ]


def _exits(machine, times: list[int], signals: list[str], entries: list[tuple]) -> list[tuple]:
    """Fold from all entries at once; entries that reach the same state go on as one."""
    leader = list(range(len(entries)))
    states: dict[tuple, int] = {}
    for number, entry in enumerate(entries):
        leader[number] = states.setdefault(entry, number)
    for t, signal in zip(times, signals):
        merged: dict[tuple, int] = {}
        for state, number in states.items():
            leader[number] = merged.setdefault(machine.step(state, t, signal)[0], number)
        states = merged
    final = {number: state for state, number in states.items()}

    def follow(number: int) -> int:
        while leader[number] != number:
            number = leader[number]
        return number

    return [final[follow(number)] for number in range(len(entries))]


def _chain(machine, chunks: pd.DataFrame) -> list[tuple]:
    """Real entry state of every chunk of a key, from the tables of the chunks before it."""
    state, real = machine.start, []
    for row in chunks.sort_values(CHUNK).itertuples():
        real.append(state)
        head, first = list(row.head), row.first
        lookup = {e: n for n, e in enumerate(_entries(machine, head, row.outlasts))}
        split = len(state) - machine.timers
        named = []
        for resume in state[split:]:
            later = [t for t in head if t >= resume]
            named.append(NO_PAUSE if resume <= first else later[0] if later else OUTLASTS)
        reached = tuple(int(v) for v in row.exits[lookup[(*state[:split], *named)]])
        resumes = [old if new == OUTLASTS else new for old, new in zip(state[split:], reached[split:])]
        state = (*reached[:split], *resumes)
    return real


def _fold(
    readings: DataFrame, machine, signal: str, rows_per_chunk: int, size_at: int
) -> DataFrame:
    """``(dim, t, signal)`` rows with the size after each reading and the action taken."""
    time_type = readings.schema["t"].dataType
    dim = f"dim {readings.schema['dim'].dataType.simpleString()}"
    micros = readings.select(
        "dim", F.unix_micros(F.col("t").cast("timestamp")).alias("t"), F.col(signal).alias("signal")
    )
    chunked = chunk(micros, ["dim"], ["t", "signal"], rows_per_chunk, ROWS_PER_FOLD)

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "signal"])
        times, signals = pdf["t"].tolist(), pdf["signal"].tolist()
        head, outlasts = _head(machine, times)
        exits = _exits(machine, times, signals, _entries(machine, head, outlasts))
        return pd.DataFrame(
            {
                "dim": [pdf["dim"].iloc[0]],
                CHUNK: [pdf[CHUNK].iloc[0]],
                "first": [times[0]],
                "head": [head],
                "outlasts": [outlasts],
                "exits": [[list(state) for state in exits]],
            }
        )

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        real = _chain(machine, pdf)
        ordered = pdf.sort_values(CHUNK)
        return pd.DataFrame(
            {"dim": ordered["dim"], CHUNK: ordered[CHUNK], "entry": [list(s) for s in real]}
        )

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "signal"])
        entry = pdf["entry"].iloc[0]
        state = tuple(int(v) for v in entry) if len(entry) else machine.start
        sizes, actions = [], []
        for t, name in zip(pdf["t"].tolist(), pdf["signal"].tolist()):
            state, action = machine.step(state, t, name)
            sizes.append(state[size_at])
            actions.append(action)
        return pdf[["dim", "t", "signal"]].assign(size=sizes, action=actions)

    from_start = F.array().cast("array<long>")
    rows = chunked.df.withColumn("entry", from_start)
    if chunked.hot:
        tables = chunked.hot_rows().groupBy("dim", CHUNK).applyInPandas(
            table,
            f"{dim}, {CHUNK} INT, first LONG, head ARRAY<LONG>, outlasts BOOLEAN, "
            "exits ARRAY<ARRAY<LONG>>",
        )
        entries = tables.groupBy("dim").applyInPandas(
            chain, f"{dim}, {CHUNK} INT, entry ARRAY<LONG>"
        )
        joined = null_safe_join(chunked.df, entries, ["dim", CHUNK], "left")
        rows = joined.withColumn("entry", F.coalesce("entry", from_start))
    folded = rows.groupBy("dim", CHUNK).applyInPandas(
        fold, f"{dim}, t LONG, signal STRING, size LONG, action LONG"
    )
    return folded.select(
        "dim",
        F.timestamp_micros("t").cast(time_type).alias("t"),
        F.col("signal").alias(signal),
        "size",
        "action",
    )


def scaling_decisions(
    labelled: DataFrame, params: ScalingParams = ScalingParams(), rows_per_chunk: int = ROWS_PER_FOLD
) -> DataFrame:
    """Size and action after every labelled reading ``(dim, t, label)``.

    The step down is tried first. Counters outlive an action; a step with ``down`` at its limit
    pauses the dimension, and readings within the pause are skipped, not counted.
    """
    return _fold(labelled, CounterMachine(params), "label", rows_per_chunk, size_at=2)


def policy_actions(
    alarms: DataFrame, params: PolicyParams = PolicyParams(), rows_per_chunk: int = ROWS_PER_FOLD
) -> DataFrame:
    """Size and action after every alarm ``(dim, t, rule)``, within limits and cooldowns."""
    return _fold(alarms, PolicyMachine(params), "rule", rows_per_chunk, size_at=0)
