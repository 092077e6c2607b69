"""The error of an epoch: one job over the sub-blocks, whatever the number of turns."""

from dataclasses import replace

import numpy as np
import pytest

import tesselar.operators.cuts as cuts_module
import tesselar.operators.dsgd as dsgd
from tesselar.operators.cuts import Cuts, fitting_cuts, id_counts
from tesselar.operators.dsgd import FactorStore, block_layout, dsgd_update
from tesselar.operators.factors import init_factors, observed_ids
from tesselar.operators.grid import measured_grid
from tesselar.plans.train import TrainingParams, measured_cuts, train_factors
from tests.test_dsgd import RANK, as_df, as_model, grouped_ratings, make_ratings


def squared_error(ratings, model):
    return sum((r - model["W", i] @ model["H", j]) ** 2 for i, j, r in ratings)


@pytest.mark.parametrize("schedule", ["strata", "row_major"])
def test_an_epoch_writes_the_vectors_once_a_turn(spark, monkeypatch, schedule):
    """They were written by all turns but two once more, only to be measured."""
    ratings = make_ratings(40, 30, 900, hot=5)
    df = as_df(spark, ratings)
    params = TrainingParams(RANK, blocks=2, epochs=2, rows_per_block=50, schedule=schedule)
    turns = measured_cuts(id_counts(df), params, df).turns
    written, write = [], FactorStore.write
    monkeypatch.setattr(FactorStore, "write", lambda self, placed: (written.append(1), write(self, placed))[1])
    factors, log = train_factors(df, params)
    assert turns > 4 and len(written) == 1 + params.epochs * turns
    errors = [row["squared_error"] for row in log.orderBy("iteration").collect()]
    assert errors[1] == pytest.approx(squared_error(ratings, as_model(factors)), rel=1e-12)
    once = train_factors(df, replace(params, epochs=1))[0]
    assert errors[0] == pytest.approx(squared_error(ratings, as_model(once)), rel=1e-12)


@pytest.mark.parametrize("copies", [1, 1 << 14])
def test_errors_of_sub_blocks(spark, monkeypatch, copies):
    monkeypatch.setattr(cuts_module, "ROWS_PER_BLOCK", 40)
    monkeypatch.setattr(dsgd, "COPIES", copies)
    ratings = grouped_ratings()
    df = as_df(spark, ratings)
    counted = fitting_cuts(measured_grid(df, 2), id_counts(df), 40, df)
    for cuts in (counted, Cuts(counted.grid, counted.rows, counted.cols), Cuts.whole_blocks(counted.grid)):
        layout = block_layout(df, cuts)
        # Also an item that nobody rated, and errors of a turn that are not vectors.
        factors = init_factors(observed_ids(df).union(spark.createDataFrame([("H", 999)], "role STRING, id LONG")), RANK, 1)
        store = FactorStore(layout, factors)
        store.write(dsgd_update(layout, store.read(), 0, 0.0, measure="after"))
        cells = [tuple(row) for row in dsgd.cell_errors(layout, store.model()).collect()]
        assert len(cells) == len({(r, c) for r, c in zip(Cuts.strip(cuts.rows, np.array([x[0] for x in ratings])).tolist(), Cuts.strip(cuts.cols, np.array([x[1] for x in ratings])).tolist())})
        assert sum(n for _, n in cells) == len(ratings)
        assert sum(e for e, _ in cells) == pytest.approx(squared_error(ratings, as_model(factors)), rel=1e-12)
        missing = factors.where("role = 'W' or id <> " + str(ratings[0][1]))
        with pytest.raises(Exception, match="no H vector"):
            dsgd.cell_errors(layout, missing).collect()


def test_no_ratings(spark):
    factors, log = train_factors(as_df(spark, []), TrainingParams(RANK, blocks=2, epochs=1))
    assert factors.count() == 0 and log.count() == 1
