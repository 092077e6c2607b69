"""State machines folded in chunks against one sequential loop."""

import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesselar.operators.alarms import AlarmRule
from tesselar.operators.scaling import (
    CounterMachine,
    PolicyMachine,
    PolicyParams,
    ScalingParams,
    _chain,
    _entries,
    _exits,
    _head,
    policy_actions,
    scaling_decisions,
)

SECOND = 1_000_000


def sequential(machine, readings, size_at):
    state, rows = machine.start, []
    for t, signal in sorted(readings):
        state, action = machine.step(state, t, signal)
        rows.append((t, signal, state[size_at], action))
    return rows


def chained_entries(machine, chunks):
    tables = []
    for number, readings in enumerate(chunks):
        times, signals = [t for t, _ in readings], [s for _, s in readings]
        head, outlasts = _head(machine, times)
        exits = _exits(machine, times, signals, _entries(machine, head, outlasts))
        tables.append((number, times[0], head, outlasts, exits))
    frame = pd.DataFrame(tables, columns=["_chunk", "first", "head", "outlasts", "exits"])
    return _chain(machine, frame)


def assert_chunks_agree(machine, readings, cuts):
    readings = sorted(readings)
    edges = [0, *sorted(set(cuts)), len(readings)]
    chunks = [readings[a:b] for a, b in zip(edges, edges[1:]) if a < b]
    # Readings of one time stay together.
    for left, right in zip(chunks, chunks[1:]):
        if left[-1][0] == right[0][0]:
            return
    states, state = [], machine.start
    for chunk in chunks:
        states.append(state)
        for t, signal in chunk:
            state, _ = machine.step(state, t, signal)
    for real, found, chunk in zip(states, chained_entries(machine, chunks), chunks):
        assert walk(machine, real, chunk) == walk(machine, found, chunk)


def walk(machine, state, chunk):
    actions = []
    for t, signal in chunk:
        state, action = machine.step(state, t, signal)
        actions.append((state[0] if machine.timers == 2 else state[2], action))
    return actions


labels = st.sampled_from(["up", "down", "neutral"])
gaps = st.integers(1, 40)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(gaps, labels), min_size=1, max_size=60),
    st.lists(st.integers(1, 59), max_size=6),
    st.integers(1, 3),
    st.integers(0, 120),
    st.integers(1, 2),
)
def test_counter_chunks(steps, cuts, count, cooldown, delta):
    machine = CounterMachine(
        ScalingParams(min_size=1, max_size=3, count=count, cooldown=cooldown, delta=delta)
    )
    t, readings = 0, []
    for gap, label in steps:
        t += gap * SECOND
        readings.append((t, label))
    assert_chunks_agree(machine, readings, [cut for cut in cuts if cut < len(readings)])


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(gaps, st.sampled_from(["scale_up", "scale_down"])), min_size=1, max_size=50),
    st.lists(st.integers(1, 49), max_size=6),
    st.integers(0, 200),
    st.integers(0, 200),
)
def test_policy_chunks(steps, cuts, up_cooldown, down_cooldown):
    rules = (
        AlarmRule("scale_up", ">", 65.0, 180, 1, up_cooldown),
        AlarmRule("scale_down", "<", 25.0, 240, -1, down_cooldown),
    )
    machine = PolicyMachine(PolicyParams(rules=rules))
    t, readings = 0, []
    for gap, name in steps:
        t += gap * SECOND
        readings.append((t, name))
    assert_chunks_agree(machine, readings, [cut for cut in cuts if cut < len(readings)])


def test_counter_rules():
    params = ScalingParams(min_size=1, max_size=2, count=2, cooldown=60, period=5)
    label = lambda text: [
        (n * 5 * SECOND, {"u": "up", "d": "down", "n": "neutral"}[c]) for n, c in enumerate(text)
    ]
    actions = lambda text: [row[3] for row in sequential(CounterMachine(params), label(text), 2)]
    assert actions("uu") == [0, 1]
    # A down between two ups resets nothing, a neutral does.
    assert actions("udu") == [0, 0, 1]
    assert actions("unu") == [0, 0, 0]
    # Both counters at their limit: the step down is tried first. Every step pauses 65 seconds
    # then, also the step up that follows, as the downs were never reset.
    assert actions("uudd" + "u" * 14) == [0, 1, 0, -1] + [0] * 12 + [1, 0]


def test_large_delta_never_pauses():
    params = ScalingParams(min_size=1, max_size=2, count=1, delta=2)
    readings = [(n * SECOND, label) for n, label in enumerate(["up", "down", "neutral", "up"])]
    assert [row[3] for row in sequential(CounterMachine(params), readings, 2)] == [1, -1, 0, 1]


def signals(spark, names, column, n, seed):
    rng = random.Random(seed)
    rows, t = [], 0
    for _ in range(n):
        t += rng.randint(1, 30) * SECOND
        rows.append(("a" if rng.random() < 0.7 else "b", t, rng.choice(names)))
    df = spark.createDataFrame(rows, f"dim STRING, us LONG, {column} STRING")
    return rows, df.select("dim", F.timestamp_micros("us").alias("t"), column)


@pytest.mark.parametrize("rows_per_chunk", [15, 80, 10_000])
def test_scaling_decisions(spark, rows_per_chunk):
    params = ScalingParams(min_size=1, max_size=4, count=2, cooldown=90)
    rows, df = signals(spark, ["up", "down", "neutral"], "label", 400, 5)
    result = scaling_decisions(df, params, rows_per_chunk).orderBy("dim", "t").collect()
    expected = [
        (dim, size, action)
        for dim in ("a", "b")
        for _, _, size, action in sequential(
            CounterMachine(params), [(t, s) for d, t, s in rows if d == dim], 2
        )
    ]
    assert [(row["dim"], row["size"], row["action"]) for row in result] == expected


@pytest.mark.parametrize("rows_per_chunk", [15, 10_000])
def test_policy_actions(spark, rows_per_chunk):
    rows, df = signals(spark, ["scale_up", "scale_down"], "rule", 300, 6)
    result = policy_actions(df, rows_per_chunk=rows_per_chunk).orderBy("dim", "t").collect()
    expected = [
        (dim, size, action)
        for dim in ("a", "b")
        for _, _, size, action in sequential(
            PolicyMachine(PolicyParams()), [(t, s) for d, t, s in rows if d == dim], 0
        )
    ]
    assert [(row["dim"], row["size"], row["action"]) for row in result] == expected
