"""Training loop: epochs over strata, with the factors written out after every sub-epoch."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselar.functions.grid import ROW_MAJOR, STRATA
from tesselar.operators.cuts import Cuts, fitting_cuts, id_counts
from tesselar.operators.dsgd import IN_ORDER, FactorStore, block_layout, dsgd_update
from tesselar.operators.evaluate import total_error
from tesselar.operators.factors import fill_missing_factors, init_factors
from tesselar.operators.grid import Grid
from tesselar.operators.skew import ROWS_PER_BLOCK
from tesselar.operators.slices import TravellingFactors, rows_per_slice, slice_layout

LOG_SCHEMA = "iteration INT, seconds DOUBLE, squared_error DOUBLE, rmse DOUBLE"


@dataclass(frozen=True)
class TrainingParams:
    """The published defaults of the distributed drafts.

    ``blocks`` is the grid that decides the order of learning; it never follows the size of the data. Blocks are cut
    where they hold more than ``rows_per_block`` ratings, which changes no result. ``order`` names the columns that
    order the samples of a block; with another order than the default one blocks are cut along it, see ``slices``.
    """

    rank: int
    blocks: int = 8
    epochs: int = 5
    eta: float = 0.015
    decay: float = 0.99
    update: str = "simultaneous"
    seed: int = 1
    base: int = 0
    schedule: str = STRATA
    order: tuple[str, ...] = IN_ORDER
    rows_per_block: int = ROWS_PER_BLOCK

    @classmethod
    def out_of_core(cls, rank: int, blocks: int = 8) -> "TrainingParams":
        """The defaults of the single-machine program, which visits blocks row by row."""
        return cls(rank, blocks, 10, 0.001, 0.99, "sequential", schedule=ROW_MAJOR)


def training_log(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """One row per epoch."""
    return spark.createDataFrame(rows, LOG_SCHEMA)


def measured_cuts(counts: DataFrame, params: TrainingParams, ratings: DataFrame | None = None) -> Cuts:
    """The grid over the ids of ``counts`` (``cuts.id_counts``) and its strips, see ``fitting_cuts``.

    Above ``rows_per_block`` ratings, learning in another order than the default one takes slices; the strips only measure.
    """
    largest = {row["role"]: row["id"] for row in counts.groupBy("role").agg(F.max("id").alias("id")).collect()}
    grid = Grid(params.blocks, largest.get("W", 0), largest.get("H", 0), params.base, params.schedule)
    return fitting_cuts(grid, counts, params.rows_per_block, ratings)


def train_factors(
    ratings: DataFrame, params: TrainingParams, factors: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train from ``factors`` (or fresh ones) and return the factors and the training log.

    The ratings are stored once; every turn reads its own part of them and the factors bucket by bucket and writes the
    factors for the next turn, so a lost executor repeats at most one turn, and no turn shuffles anything. The error of an
    epoch is one more job, see ``dsgd.cell_errors``.
    """
    spark = ratings.sparkSession
    counts = id_counts(ratings)
    rows = counts.where(F.col("role") == "W").agg(F.sum("rows").alias("rows")).first()["rows"] or 0
    cuts = measured_cuts(counts, params, ratings)
    sliced = tuple(params.order) != IN_ORDER and rows > params.rows_per_block
    if sliced:
        layout = slice_layout(ratings, cuts, params.order, rows, params.rows_per_block, rows_per_slice(params.rank))
    else:
        layout = block_layout(ratings, cuts, params.order, params.rows_per_block, rows)
    if factors is None:
        factors = init_factors(counts.select("role", "id"), params.rank, params.seed)
    else:
        factors = fill_missing_factors(factors, counts, params.rank, params.seed)
    store = TravellingFactors(layout, factors) if sliced else FactorStore(layout, factors)

    eta, log, started = params.eta, [], time.perf_counter()
    for epoch in range(params.epochs):
        for turn in range(layout.turns):
            if sliced:
                store.learn(eta, params.update)
            else:
                store.write(dsgd_update(layout, store.read(), turn, eta, params.update))
        error = total_error(store.errors()).first()
        log.append((epoch, time.perf_counter() - started, error["squared_error"], error["rmse"]))
        eta *= params.decay
    store.drop()
    layout.drop()
    return store.model(), training_log(spark, log)
