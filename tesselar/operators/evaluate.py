"""Predictions and errors of a factor model."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselar.functions.vectors import dot
from tesselar.operators.cuts import fitting_cuts, id_counts
from tesselar.operators.dsgd import ERROR, FactorStore, block_layout, turn_error
from tesselar.operators.factors import rating_sides
from tesselar.operators.grid import Grid, measured_grid
from tesselar.operators.skew import ROWS_PER_BLOCK, ROWS_PER_TASK, HotKeys, find_hot_keys, skew_join

#: Blocks per side for an error that is not part of a training.
BLOCKS = 8


@dataclass(frozen=True)
class RatingSkew:
    """Hot users and hot items of a rating table, found once and used for every evaluation."""

    users: HotKeys
    items: HotKeys
    rows_per_task: int


def rating_skew(ratings: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> RatingSkew:
    """Count users and items in one pass."""
    both = rating_sides(ratings)
    found = find_hot_keys(both, ["role", "id"], rows_per_task)

    def side(role: str, axis: str) -> HotKeys:
        if not found:
            return HotKeys((axis,), 0, None)
        table = found.table.filter(F.col("role") == role)
        return HotKeys((axis,), found.rows, table.select(F.col("id").alias(axis), "key_rows"), found.keys)

    return RatingSkew(side("W", "i"), side("H", "j"), rows_per_task)


def _present(vec: str, role: str, axis: str) -> Column:
    problem = F.concat(F.lit(f"no {role} vector for id "), F.col(axis).cast("string"))
    return F.coalesce(F.col(vec), F.raise_error(problem).cast("array<double>"))


def rating_factor_join(
    ratings: DataFrame, factors: DataFrame, skew: RatingSkew | None = None
) -> DataFrame:
    """Both vectors next to every rating, as columns ``w`` and ``h``. A missing vector raises."""
    skew = rating_skew(ratings) if skew is None else skew

    def side(role: str, axis: str, out: str) -> DataFrame:
        rows = factors.filter(F.col("role") == role)
        return rows.select(F.col("id").alias(axis), F.col("vec").alias(out))

    joined = skew_join(
        ratings, side("W", "i", "w"), ["i"], ["j", "r"], "left", skew.rows_per_task, skew.users
    )
    joined = skew_join(
        joined, side("H", "j", "h"), ["j"], ["i", "r"], "left", skew.rows_per_task, skew.items
    )
    return joined.withColumns({"w": _present("w", "W", "i"), "h": _present("h", "H", "j")})


def predict(joined: DataFrame, rank: int | None = None) -> DataFrame:
    return joined.withColumn("prediction", dot("w", "h", rank))


def found_errors(store: FactorStore) -> DataFrame:
    """``rb``, ``cb``, ``squared_error``, ``n`` from the error rows of a store, one for each block."""
    number, n = F.col("id"), F.lit(store.layout.cuts.grid.n)
    found = store.files().where(F.col("role") == ERROR).select(
        F.call_function("div", number, n).cast("int").alias("rb"),
        F.pmod(number, n).cast("int").alias("cb"),
        F.col("vec")[0].alias("squared_error"),
        F.col("vec")[1].cast("long").alias("n"),
    )
    return found.groupBy("rb", "cb").agg(F.sum("squared_error").alias("squared_error"), F.sum("n").alias("n"))


def stored_block_error(store: FactorStore) -> DataFrame:
    """Squared error and sample count of every (row block, column block) that has samples.

    Item vectors pass through the turns of the layout, each bucket adds up its sub-block, and one row per sub-block
    remains: no vector is shuffled. The store must be placed for turn 0 and is so again afterwards.
    """
    layout = store.layout
    for turn in range(layout.cuts.turns):
        store.write(turn_error(layout, store.read(), turn, (turn + 1) % layout.cuts.turns, carry=turn > 0))
    return found_errors(store)


def block_error(ratings: DataFrame, factors: DataFrame, grid: Grid, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Squared error and sample count of every (row block, column block). A missing vector raises.

    Samples and vectors are stored in the buckets of the grid first, hot ids in strips of about ``rows_per_block``.
    """
    cuts = replace(fitting_cuts(grid, id_counts(ratings), rows_per_block, ratings), any_order=True)
    layout = block_layout(ratings, cuts, rows_per_block=rows_per_block)
    store = FactorStore(layout, factors)
    errors = stored_block_error(store)
    store.drop()
    layout.drop()
    return errors


def total_error(errors: DataFrame) -> DataFrame:
    """Squared error, sample count and RMSE over all blocks."""
    total = errors.agg(F.sum("squared_error").alias("squared_error"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return total.withColumn("rmse", F.sqrt(F.col("squared_error") / F.col("n")))


def model_error(ratings: DataFrame, factors: DataFrame, blocks: int = BLOCKS, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Squared error, sample count and RMSE over all ratings."""
    return total_error(block_error(ratings, factors, measured_grid(ratings, blocks), rows_per_block))
