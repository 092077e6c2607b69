"""Block arithmetic: id 0, uneven widths, more blocks than ids."""

import pytest

from tesselar.operators.grid import (
    assign_blocks,
    block_cogroup_counts,
    block_data_right_join,
    block_factor_join,
    measured_grid,
    rotate_items,
)


def ratings(spark, pairs):
    return spark.createDataFrame([(i, j, 1.0) for i, j in pairs], "i LONG, j LONG, r DOUBLE")


@pytest.mark.parametrize("n", [1, 3, 4, 10, 25])
def test_zero_based_blocks(spark, n):
    blocked = assign_blocks(ratings(spark, [(x, 2 * x) for x in range(11)]), n).collect()
    for row in blocked:
        # The width rule of the out-of-core program: floor((max + n) / n).
        assert row["rb"] == row["i"] // ((10 + n) // n)
        assert row["cb"] == row["j"] // ((20 + n) // n)
        assert row["rb"] < n and row["cb"] < n
        assert row["s"] == (row["cb"] - row["rb"]) % n


@pytest.mark.parametrize("n", [1, 3, 4, 8, 20])
def test_one_based_blocks(spark, n):
    blocked = assign_blocks(ratings(spark, [(x, x) for x in range(16)]), n, base=1).collect()
    width = max(-(-15 // n), 1)
    for row in blocked:
        assert row["rb"] == max(row["i"] - 1, 0) // width
        assert row["rb"] < n


def test_measured_grid_equals_subqueries(spark):
    df = ratings(spark, [(x % 17, x % 29) for x in range(100)])
    left = assign_blocks(df, 4).collect()
    right = assign_blocks(df, 4, grid=measured_grid(df, 4)).collect()
    assert sorted(left) == sorted(right)


def test_block_sides(spark):
    w = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (9, 2)], "id LONG, key INT")
    h = spark.createDataFrame([(5, 0), (6, 1), (7, 1), (8, 3)], "id LONG, key INT")
    joined = block_factor_join(w, h)
    assert sorted(map(tuple, joined.collect())) == [(0, 2, 1, 2, 1, 5, 5), (1, 1, 3, 3, 2, 6, 7)]
    blocked = spark.createDataFrame([(0, 1)] * 4, "rb INT, cb INT")
    right = block_data_right_join(blocked, joined).select("key", "samples", "w_rows", "h_rows")
    assert sorted(map(tuple, right.collect()), key=str) == [(0, 4, 2, 1), (1, None, 1, 2)]
    counts = block_cogroup_counts(blocked, w, h)
    assert sorted(map(tuple, counts.collect())) == [(0, 4, 2, 1), (1, 0, 1, 2), (2, 0, 1, 0), (3, 0, 0, 1)]


def test_rotation_meets_the_stratum(spark):
    items = spark.createDataFrame([(c,) for c in range(5)], "cb INT")
    for offset in range(5):
        for row in rotate_items(items, offset, 5).collect():
            assert (row["key"] + offset) % 5 == row["cb"]
