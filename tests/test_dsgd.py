"""Distributed SGD against a serial loop."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselar.operators import cuts as cuts_module
from tesselar.operators.cuts import Cuts, fitting_cuts, id_counts
from tesselar.operators.dsgd import block_layout, dsgd_update, place_factors, sample_levels
from tesselar.operators.evaluate import block_error, model_error
from tesselar.operators.factors import init_factors, observed_ids
from tesselar.operators.grid import Grid, assign_blocks, measured_grid
from tesselar.plans.files import score_files, train_files
from tesselar.plans.train import TrainingParams, measured_cuts, train_factors
from tesselar.workspace import bucket_keys

RANK = 4


def make_ratings(n_users, n_items, count, seed=0, hot=None):
    rng = np.random.default_rng(seed)
    users = rng.integers(0, n_users, count)
    items = rng.integers(0, n_items, count)
    if hot is not None:
        items[: count // 3] = hot
    stars = rng.integers(1, 6, count).astype(float)
    return sorted(zip(users.tolist(), items.tolist(), stars.tolist()))


def as_df(spark, ratings):
    return spark.createDataFrame(ratings, "i LONG, j LONG, r DOUBLE")


def as_model(factors):
    return {(row["role"], row["id"]): np.array(row["vec"]) for row in factors.collect()}


def serial_sub_epoch(ratings, model, grid, offset, eta, update):
    row_width = -(-(grid.max_i + 1) // grid.n)
    col_width = -(-(grid.max_j + 1) // grid.n)
    for i, j, r in ratings:
        if (i // row_width + offset) % grid.n != j // col_width:
            continue
        w, h = model["W", i].copy(), model["H", j].copy()
        step = 2 * eta * (r - w @ h)
        model["W", i] = w + step * h
        model["H", j] = h + step * (model["W", i] if update == "sequential" else w)


def assert_same_model(left, right):
    assert left.keys() == right.keys()
    for key in left:
        np.testing.assert_allclose(left[key], right[key], rtol=1e-10, atol=1e-12)


def whole(df, blocks):
    return Cuts.whole_blocks(measured_grid(df, blocks))


@pytest.mark.parametrize("update", ["simultaneous", "sequential"])
@pytest.mark.parametrize("blocks, hot", [(3, None), (4, 5), (30, None)])
def test_sub_epochs_equal_serial_loop(spark, update, blocks, hot):
    ratings = make_ratings(23, 19, 700, hot=hot)
    df = as_df(spark, ratings)
    cuts = whole(df, blocks)
    layout = block_layout(df, cuts)
    factors = init_factors(observed_ids(df), RANK, 1)
    model = as_model(factors)
    for offset in (0, blocks - 1):
        factors = dsgd_update(layout, place_factors(factors, layout, offset), offset, 0.01, update)
        serial_sub_epoch(ratings, model, cuts.grid, offset, 0.01, update)
    assert_same_model(as_model(factors), model)


def serial_levels(users, items):
    last, levels = {}, []
    for user, item in zip(users, items):
        level = 1 + max(last.get(("W", user), 0), last.get(("H", item), 0))
        last["W", user] = last["H", item] = level
        levels.append(level)
    return levels


@pytest.mark.parametrize("n_users, n_items, count, hot", [(1, 1, 1, 0), (40, 30, 900, 3), (3000, 2000, 9000, None), (3000, 2000, 9000, 7), (5, 2000, 4000, None)])
def test_levels_equal_serial_levels(n_users, n_items, count, hot):
    """Wide and narrow frontiers, in the order of ids and in any other."""
    ratings = make_ratings(n_users, n_items, count, hot=hot)
    for order in (ratings, [ratings[at] for at in np.random.default_rng(1).permutation(count)]):
        users, items = (np.array([row[axis] for row in order], np.int64) for axis in (0, 1))
        assert sample_levels(users, items).tolist() == serial_levels(users.tolist(), items.tolist())
    assert sample_levels(np.empty(0, np.int64), np.empty(0, np.int64)).tolist() == []


def test_levels_share_no_user_and_no_item(spark):
    df = as_df(spark, make_ratings(40, 30, 900, hot=3))
    samples = block_layout(df, whole(df, 3)).samples
    assert samples.count() == 900
    for axis in ("i", "j"):
        repeated = samples.groupBy("rs", "cs", "lvl", axis).count().filter("count > 1")
        assert repeated.count() == 0


def test_bucket_keys_reach_every_bucket(spark):
    for n in (1, 2, 7, 100):
        keys = bucket_keys(spark, n)
        rows = spark.createDataFrame([(key,) for key in keys], "key INT").select(F.pmod(F.hash("key"), F.lit(n)).alias("bucket"))
        assert [row["bucket"] for row in rows.collect()] == list(range(n))


@pytest.mark.parametrize("schedule", ["strata", "row_major"])
def test_turns_of_strips(schedule):
    """Uneven strips: all pairs have a turn, of one turn no two share a strip, and items wait where they are needed next."""
    grid = Grid(3, 29, 19, 0, schedule)
    cuts = Cuts(grid, (0, 1, 5, 10, 20, 21, 22), (0, 7, 9, 14, 15, 16))
    assert cuts.row_blocks.tolist() == [0, 0, 0, 1, 2, 2, 2] and cuts.col_blocks.tolist() == [0, 1, 1, 2, 2, 2]
    rows, cols = (x.ravel() for x in np.meshgrid(range(7), range(6), indexing="ij"))
    turns = cuts.turn(rows, cols)
    assert turns.min() == 0 and turns.max() < cuts.turns
    for turn in range(cuts.turns):
        now = turns == turn
        assert len(set(rows[now])) == len(set(cols[now])) == now.sum()
        met = cuts.met_by(turn)
        assert (met[cols[now]] == rows[now]).all()
    # Whatever shares a strip is learned in the order of the whole blocks.
    for strip, other in ((rows, cols), (cols, rows)):
        for value in set(strip.tolist()):
            inside = strip == value
            block = (cuts.row_blocks if other is rows else cuts.col_blocks)[other[inside]]
            for parent in set(block.tolist()):
                assert (np.diff(turns[inside][block == parent]) > 0).all()


def test_strata_partition_the_blocks(spark):
    blocked = assign_blocks(as_df(spark, make_ratings(50, 50, 800)), 5)
    blocks = blocked.select("s", "rb", "cb").distinct().toPandas()
    assert not blocks.duplicated(["rb", "cb"]).any()
    assert not blocks.duplicated(["s", "rb"]).any()
    assert not blocks.duplicated(["s", "cb"]).any()


def test_factors_of_empty_blocks_pass_through(spark):
    df = as_df(spark, [(0, 0, 5.0), (9, 9, 1.0)])
    factors = init_factors(observed_ids(df), RANK, 1)
    layout = block_layout(df, whole(df, 2))
    updated = dsgd_update(layout, place_factors(factors, layout, 1), 1, 0.1)
    assert_same_model(as_model(updated), as_model(factors))


def test_missing_vector_raises(spark):
    df = as_df(spark, make_ratings(10, 10, 50))
    factors = init_factors(observed_ids(df), RANK, 1).filter("not (role = 'W' and id = 3)")
    layout = block_layout(df, whole(df, 2))
    with pytest.raises(Exception, match="no W vector for id 3"):
        for offset in range(2):
            dsgd_update(layout, place_factors(factors, layout, offset), offset, 0.1).collect()
    with pytest.raises(Exception, match="no W vector for id 3"):
        model_error(df, factors).collect()


def test_incomplete_ratings_raise(spark):
    for row in ((None, 1, 1.0), (1, None, 1.0), (1, 1, None)):
        df = as_df(spark, [(0, 0, 5.0), row])
        with pytest.raises(Exception, match="without user, item or value"):
            block_layout(df, whole(df, 2))


def test_training_equals_serial_loop(spark):
    ratings = make_ratings(31, 27, 900, hot=0)
    df = as_df(spark, ratings)
    params = TrainingParams(rank=RANK, blocks=4, epochs=3, eta=0.02, decay=0.9)
    factors, log = train_factors(df, params)
    grid = measured_grid(df, 4)
    model = as_model(init_factors(observed_ids(df), RANK, params.seed))
    eta, errors = params.eta, []
    for _ in range(params.epochs):
        for offset in range(4):
            serial_sub_epoch(ratings, model, grid, offset, eta, params.update)
        errors.append(sum((r - model["W", i] @ model["H", j]) ** 2 for i, j, r in ratings))
        eta *= params.decay
    assert_same_model(as_model(factors), model)
    rows = log.orderBy("iteration").collect()
    np.testing.assert_allclose([row["squared_error"] for row in rows], errors)
    np.testing.assert_allclose([row["rmse"] for row in rows], np.sqrt(np.array(errors) / 900))
    assert errors == sorted(errors, reverse=True)


def test_training_goes_on_from_given_factors(spark):
    df = as_df(spark, make_ratings(12, 12, 200))
    known = init_factors(observed_ids(df.filter("r > 3")), RANK, 1)
    factors, _ = train_factors(df, TrainingParams(rank=RANK, blocks=2, epochs=1), known)
    assert factors.count() == observed_ids(df).count()


def test_error_with_blocks_cut(spark):
    ratings = make_ratings(20, 20, 600, hot=4)
    df = as_df(spark, ratings)
    factors = init_factors(observed_ids(df), RANK, 1)
    model = as_model(factors)
    expected = sum((r - model["W", i] @ model["H", j]) ** 2 for i, j, r in ratings)
    for rows in (10_000, 25):
        found = model_error(df, factors, 3, rows).first()
        assert found["n"] == 600
        assert found["squared_error"] == pytest.approx(expected, rel=1e-12)
        assert found["rmse"] == pytest.approx((expected / 600) ** 0.5, rel=1e-12)
    blocks = block_error(df, factors, measured_grid(df, 3), 25).collect()
    assert sum(row["n"] for row in blocks) == 600 and len(blocks) == 9
    for row in blocks:
        inside = [(r - model["W", i] @ model["H", j]) ** 2 for i, j, r in ratings if (i // 7, j // 7) == (row["rb"], row["cb"])]
        assert row["n"] == len(inside) and row["squared_error"] == pytest.approx(sum(inside), rel=1e-12)
    nothing = model_error(df.limit(0), factors.limit(0)).first()
    assert (nothing["squared_error"], nothing["n"], nothing["rmse"]) == (None, 0, None)


def sub_block_sizes(ratings, cuts):
    rows, cols = (np.array([r[axis] for r in ratings]) for axis in (0, 1))
    number = cuts.strip(cuts.rows, rows) * len(cuts.cols) + cuts.strip(cuts.cols, cols)
    return np.bincount(number, minlength=len(cuts.rows) * len(cuts.cols))


def test_cuts_follow_the_weight(spark):
    """A third of all ratings on one item: many thin row strips, few column strips, no sub-block far above its size."""
    rng = np.random.default_rng(3)
    ratings = [(int(i), int(j), 1.0) for i, j in zip(rng.integers(0, 500, 6000), rng.zipf(1.5, 6000) % 400)]
    ratings += [(int(i), 17, 1.0) for i in rng.integers(0, 500, 3000)]
    df = as_df(spark, ratings)
    cuts = fitting_cuts(measured_grid(df, 4), id_counts(df), 100)
    sizes = sub_block_sizes(ratings, cuts)
    assert sizes.max() <= 250
    assert len(cuts.rows) > 1.5 * len(cuts.cols) and len(cuts.rows) <= 2 * 3000 / 100 + 8
    assert len(cuts.rows) * len(cuts.cols) < 30 * 9000 / 100
    assert set(Cuts.whole_blocks(cuts.grid).rows) <= set(cuts.rows)
    assert fitting_cuts(measured_grid(df, 4), id_counts(df), 10_000) == Cuts.whole_blocks(measured_grid(df, 4))


def test_cuts_of_wide_id_ranges(spark):
    """Ids far apart: the histogram is refined where the ratings are."""
    ratings = [(1_000_000_007 * (n % 3) + n % 50, 40_000_000 + n % 90, 1.0) for n in range(3000)]
    df = as_df(spark, ratings)
    cuts = fitting_cuts(measured_grid(df, 2), id_counts(df), 50)
    assert sub_block_sizes(ratings, cuts).max() <= 150


@pytest.mark.parametrize("schedule", ["strata", "row_major"])
@pytest.mark.parametrize("base", [0, 1])
def test_cuts_keep_the_model(spark, schedule, base):
    df = as_df(spark, make_ratings(23, 19, 400, hot=5)).withColumns(
        {"i": F.col("i") + base, "j": F.col("j") + base}
    )
    models = []
    for rows in (10_000, 60, 15):
        params = TrainingParams(RANK, blocks=3, epochs=2, schedule=schedule, base=base, rows_per_block=rows)
        strips = measured_cuts(id_counts(df), params)
        assert (len(strips.rows) + len(strips.cols) > 6) == (rows < 10_000)
        models.append(as_model(train_factors(df, params)[0]))
    for model in models[1:]:
        assert_same_model(models[0], model)


def test_other_orders_are_not_cut(spark):
    df = as_df(spark, make_ratings(5, 5, 20)).withColumn("line", F.col("i"))
    cuts = fitting_cuts(measured_grid(df, 2), id_counts(df), 3)
    with pytest.raises(ValueError):
        block_layout(df, cuts, ("line",))


def test_files_train_and_score(spark, tmp_path):
    ratings = make_ratings(15, 11, 300)
    (tmp_path / "ratings.csv").write_text("".join(f"{i},{j},{r}\n" for i, j, r in ratings))
    paths = [str(tmp_path / name) for name in ("ratings.csv", "w", "h")]
    log = train_files(spark, *paths, TrainingParams(rank=RANK, blocks=3, epochs=2))
    last = log.orderBy("iteration").collect()[-1]
    score = score_files(spark, paths[1], paths[2], paths[0]).first()
    assert score["n"] == 300
    assert score["rmse"] == pytest.approx(last["rmse"], rel=1e-12)


def serial_row_major(ratings, model, grid, eta):
    """Blocks row by row, the item's step with the updated user row."""
    row_width = -(-(grid.max_i + 1) // grid.n)
    col_width = -(-(grid.max_j + 1) // grid.n)
    for i, j, r in sorted(ratings, key=lambda x: (x[0] // row_width, x[1] // col_width, *x)):
        step = 2 * eta * (r - model["W", i] @ model["H", j])
        model["W", i] = model["W", i] + step * model["H", j]
        model["H", j] = model["H", j] + step * model["W", i]


@pytest.mark.parametrize("blocks", [1, 3, 5])
def test_row_major_training_equals_serial_visit(spark, blocks):
    ratings = make_ratings(21, 17, 500, hot=2)
    df = as_df(spark, ratings)
    params = replace(TrainingParams.out_of_core(RANK, blocks), epochs=2, eta=0.02)
    factors, _ = train_factors(df, params)
    grid = measured_grid(df, blocks)
    model = as_model(init_factors(observed_ids(df), RANK, params.seed))
    for epoch in range(2):
        serial_row_major(ratings, model, grid, 0.02 * 0.99**epoch)
    assert_same_model(as_model(factors), model)


def test_samples_in_line_order(spark):
    ratings = make_ratings(9, 9, 200)
    np.random.default_rng(8).shuffle(ratings)
    numbered = [(int(i), int(j), float(r), n) for n, (i, j, r) in enumerate(ratings)]
    df = spark.createDataFrame(numbered, "i LONG, j LONG, r DOUBLE, line LONG")
    factors, _ = train_factors(df, TrainingParams(rank=RANK, blocks=1, epochs=1, order=("line",)))
    model = as_model(init_factors(observed_ids(df), RANK, 1))
    plain = [(i, j, r) for i, j, r, _ in numbered]
    serial_sub_epoch(plain, model, measured_grid(df, 1), 0, 0.015, "simultaneous")
    assert_same_model(as_model(factors), model)


def grouped_ratings(groups=6, users=12, items=9, count=600):
    """Groups of users that keep to their own items."""
    rng = np.random.default_rng(5)
    group = rng.integers(0, groups, count)
    rows = zip(group * users + rng.integers(0, users, count), group * items + rng.integers(0, items, count), rng.integers(1, 6, count))
    return sorted((int(i), int(j), float(r)) for i, j, r in rows)


def test_many_ratings_are_cut_into_larger_strips(spark):
    """A turn costs a job and a strip a bucket: with 9,000 ratings and 1 a sub-block there were 13,000 sub-blocks."""
    df = as_df(spark, make_ratings(500, 400, 9000))
    cuts = fitting_cuts(measured_grid(df, 4), id_counts(df), 1)
    assert len(cuts.rows) * len(cuts.cols) <= 2 * 256
    assert cuts.turns <= 2 * 4 * 8


def test_groups_are_cut_until_sub_blocks_fit(spark, monkeypatch):
    """Few sub-blocks hold all ratings: the product of two strips' weights says too little about them."""
    ratings = grouped_ratings()
    df = as_df(spark, ratings)
    monkeypatch.setattr(cuts_module, "ROWS_PER_BLOCK", 40)
    grid = measured_grid(df, 2)
    assert sub_block_sizes(ratings, fitting_cuts(grid, id_counts(df), 40)).max() > 60
    cuts = fitting_cuts(grid, id_counts(df), 40, df)
    sizes = sub_block_sizes(ratings, cuts)
    assert sizes.max() <= 60 and cuts.cells == tuple(np.flatnonzero(sizes).tolist())
    everywhere = Cuts(cuts.grid, cuts.rows, cuts.cols)
    assert cuts.turns < everywhere.turns
    # In any order few turns are enough to meet every sub-block once.
    measuring = replace(cuts, any_order=True)
    row, col = np.divmod(np.array(cuts.cells), len(cuts.cols))
    turns = measuring.turn(row, col)
    assert measuring.turns < cuts.turns
    for turn in range(measuring.turns):
        assert (measuring.met_by(turn)[col[turns == turn]] == row[turns == turn]).all()
    model = as_model(init_factors(observed_ids(df), RANK, 1))
    expected = sum((r - model["W", i] @ model["H", j]) ** 2 for i, j, r in ratings)
    assert model_error(df, init_factors(observed_ids(df), RANK, 1), 2, 40).first()["squared_error"] == pytest.approx(expected, rel=1e-12)
    with pytest.raises(Exception, match="take for empty"):
        block_layout(as_df(spark, [*ratings, (0, 53, 1.0)]), cuts).samples.count()


@pytest.mark.parametrize("schedule", ["strata", "row_major"])
def test_groups_keep_the_model(spark, monkeypatch, schedule):
    df = as_df(spark, grouped_ratings(4, 6, 5, 200))
    params = TrainingParams(RANK, blocks=2, epochs=2, schedule=schedule, eta=0.02)
    whole_model = as_model(train_factors(df, params)[0])
    monkeypatch.setattr(cuts_module, "ROWS_PER_BLOCK", 30)
    cuts = measured_cuts(id_counts(df), replace(params, rows_per_block=30), df)
    assert len(cuts.rows) > 2 and len(cuts.cells) < len(cuts.rows) * len(cuts.cols)
    assert_same_model(as_model(train_factors(df, replace(params, rows_per_block=30))[0]), whole_model)


def test_waiting_items_are_dealt_over_the_strips():
    """All items of a block used to wait at its first or its last row strip."""
    for schedule in ("strata", "row_major"):
        cuts = Cuts(Grid(2, 99, 99, 0, schedule), tuple(range(0, 100, 10)), tuple(range(0, 100, 10)))
        for turn in range(cuts.turns):
            assert np.bincount(cuts.met_by(turn)).max() <= 2
