"""Learning in an order of the samples' own: slices of the order against a serial loop."""

from collections import defaultdict
from dataclasses import replace

import numpy as np
import pytest

import tesselar.operators.slices as slices
from tesselar.operators.cuts import Cuts, id_counts
from tesselar.operators.factors import init_factors, observed_ids
from tesselar.operators.grid import measured_grid
from tesselar.operators.slices import TravellingFactors, slice_layout
from tesselar.plans.train import TrainingParams, measured_cuts, train_factors
from tests.test_dsgd import RANK, as_model, assert_same_model, make_ratings, serial_sub_epoch

LINES = ("line",)


def shuffled(n_users, n_items, count, hot=None):
    ratings = make_ratings(n_users, n_items, count, hot=hot)
    np.random.default_rng(8).shuffle(ratings)
    return [(int(i), int(j), float(r), n) for n, (i, j, r) in enumerate(ratings)]


def as_lines(spark, numbered):
    return spark.createDataFrame(numbered, "i LONG, j LONG, r DOUBLE, line LONG").repartition(5)


def serial_epoch(numbered, model, grid, eta, update):
    """The blocks of one turn after those of the turn before, each in the order of its lines."""
    whole = Cuts.whole_blocks(grid)
    by_turn = defaultdict(list)
    for i, j, r, _ in numbered:
        by_turn[int(whole.turn(whole.strip(whole.rows, i), whole.strip(whole.cols, j)))].append((i, j, r))
    for turn in sorted(by_turn):
        for i, j, r in by_turn[turn]:
            w, h = model["W", i].copy(), model["H", j].copy()
            step = 2 * eta * (r - w @ h)
            model["W", i] = w + step * h
            model["H", j] = h + step * (model["W", i] if update == "sequential" else w)


@pytest.mark.parametrize("schedule, update", [("strata", "simultaneous"), ("row_major", "sequential")])
def test_slices_keep_the_model_of_the_order(spark, schedule, update):
    """A block in an order of its own was one task, whatever its ratings."""
    numbered = shuffled(23, 19, 900, hot=5)
    df = as_lines(spark, numbered)
    params = TrainingParams(RANK, blocks=3, epochs=2, eta=0.02, order=LINES, schedule=schedule, update=update, rows_per_block=90)
    factors, log = train_factors(df, params)
    grid = measured_grid(df, 3)
    grid = replace(grid, schedule=schedule)
    model = as_model(init_factors(observed_ids(df), RANK, 1))
    errors = []
    for epoch in range(2):
        serial_epoch(numbered, model, grid, 0.02 * 0.99**epoch, update)
        errors.append(sum((r - model["W", i] @ model["H", j]) ** 2 for i, j, r, _ in numbered))
    assert_same_model(as_model(factors), model)
    rows = log.orderBy("iteration").collect()
    np.testing.assert_allclose([row["squared_error"] for row in rows], errors, rtol=1e-12)
    assert_same_model(as_model(train_factors(df, replace(params, rows_per_block=10_000))[0]), model)


def layout_of(spark, numbered, blocks=2, wanted=40):
    df = as_lines(spark, numbered)
    params = TrainingParams(RANK, blocks=blocks, order=LINES, rows_per_block=wanted)
    return df, slice_layout(df, measured_cuts(id_counts(df), params, df), LINES, len(numbered), wanted, wanted)


def test_a_task_holds_a_slice_and_its_vectors(spark, monkeypatch):
    """All 2,000 users of a block came to its task, with all its samples."""
    numbered = shuffled(4000, 3000, 1500)
    df, layout = layout_of(spark, numbered, 2, 100)
    sizes = layout.samples.groupBy("unit").count().toPandas()["count"]
    assert sizes.sum() == 1500 and sizes.max() <= 2 * 100
    held = []
    store = TravellingFactors(layout, init_factors(observed_ids(df), RANK, 1))
    while store.step < layout.turns:
        here = store.table.read().where(f"step = {store.step}")
        held += [sum(len(row["ids"]) // 8 for row in here.where(f"bk = {key}").collect()) for key in layout.keys]
        store.learn(0.01)
    assert max(held) <= 2 * sizes.max() and sum(held) >= observed_ids(df).count()
    # What the turns have read is gone, nothing is lost.
    assert store.table.files().where(f"step < {layout.turns}").count() == 0
    assert store.model().select("role", "id").distinct().count() == store.model().count() == observed_ids(df).count()


def test_a_turn_shuffles_nothing(spark):
    df, layout = layout_of(spark, shuffled(40, 30, 400))
    store = TravellingFactors(layout, init_factors(observed_ids(df), RANK, 1))
    for _ in range(2):
        plan = store.updated(0.01)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert "(step#" in plan and "unit#" in plan.split("PartitionFilters: ")[1]
        store.learn(0.01)


def test_ids_without_samples_and_equal_orders(spark):
    """Given vectors that nothing changes stay; samples at one place of the order follow by user, item and rating."""
    numbered = [(i, j, r, n // 300) for i, j, r, n in shuffled(23, 19, 600)]
    df = as_lines(spark, numbered)
    start = init_factors(observed_ids(df).union(spark.createDataFrame([("H", 18), ("W", 99), ("H", 500)], "role STRING, id LONG")).distinct(), RANK, 1)
    params = TrainingParams(RANK, blocks=1, epochs=1, order=LINES, rows_per_block=50)
    model = as_model(start)
    expected = dict(model)
    serial_epoch(sorted(numbered, key=lambda x: (x[3], *x[:3])), expected, measured_grid(df, 1), params.eta, params.update)
    found = as_model(train_factors(df, params, start)[0])
    assert_same_model(found, expected)
    assert (found["W", 99] == model["W", 99]).all() and (found["H", 500] == model["H", 500]).all()


def test_many_turns_and_next_steps():
    rng = np.random.default_rng(3)
    turns = 150
    visited = rng.random((200, turns)) < 0.03
    visited[0] = False
    words = np.zeros((200, 3), np.uint64)
    for row, turn in zip(*np.nonzero(visited)):
        words[row, turn // 64] |= np.uint64(1 << int(turn % 64))
    for step in (-1, 0, 62, 63, 64, 127, 149, 150 + 63, 299):
        following = slices._next_steps(words, step, turns)
        for row in range(200):
            later = [at for at in range(step + 1, step + 1 + turns) if visited[row, at % turns]]
            assert following[row] == (later[0] if later else slices.NEVER)


def test_slices_of_long_vectors_are_thinner():
    assert slices.rows_per_slice(8) * 8 == slices.rows_per_slice(100) * 100 == slices.SLICE_VALUES


def test_incomplete_ratings_raise(spark):
    df = as_lines(spark, [(0, 0, 5.0, 0), (1, None, 1.0, 1)])
    with pytest.raises(Exception, match="without user, item or value"):
        train_factors(df, TrainingParams(RANK, blocks=2, epochs=1, order=LINES, rows_per_block=1))
