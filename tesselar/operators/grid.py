"""The block grid over a rating matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselar.functions.grid import STRATA, block_index, meeting_row_block, turn


@dataclass(frozen=True)
class Grid:
    """``n`` by ``n`` blocks over ids up to ``max_i`` and ``max_j``; ``n`` decides in which order samples are learned."""

    n: int
    max_i: int | Column
    max_j: int | Column
    base: int = 0
    schedule: str = STRATA

    def row_block(self, id_col: Column) -> Column:
        return block_index(id_col, self.max_i, self.n, self.base)

    def col_block(self, id_col: Column) -> Column:
        return block_index(id_col, self.max_j, self.n, self.base)


def matrix_extent(ratings: DataFrame) -> DataFrame:
    """Largest row id and column id, in one job."""
    return ratings.agg(F.max("i").alias("max_i"), F.max("j").alias("max_j"))


def measured_grid(ratings: DataFrame, n: int, base: int = 0, schedule: str = STRATA) -> Grid:
    extent = matrix_extent(ratings).first()
    return Grid(n, extent["max_i"] or 0, extent["max_j"] or 0, base, schedule)


def distinct_entities(ratings: DataFrame, axis: str) -> DataFrame:
    """Distinct ids of the row axis ``i`` or the column axis ``j``."""
    return ratings.select(F.col(axis).alias("id")).distinct()


def assign_blocks(ratings: DataFrame, n: int, base: int = 0, grid: Grid | None = None) -> DataFrame:
    """Add row block, column block and stratum. Without a grid the extents are scalar subqueries."""
    if grid is None:
        extent = matrix_extent(ratings)
        grid = Grid(n, extent.select("max_i").scalar(), extent.select("max_j").scalar(), base)
    blocked = ratings.withColumns(
        {"rb": grid.row_block(F.col("i")), "cb": grid.col_block(F.col("j"))}
    )
    return blocked.withColumn("s", turn(F.col("rb"), F.col("cb"), grid.n, grid.schedule))


def select_stratum(blocked: DataFrame, offset: int) -> DataFrame:
    return blocked.filter(F.col("s") == offset)


def rotate_items(factors: DataFrame, offset: int, n: int) -> DataFrame:
    """Key item factors (with column block ``cb``) by the row block they meet in a stratum."""
    return factors.withColumn("key", meeting_row_block(F.col("cb"), offset, n))


def block_sizes(blocked: DataFrame) -> DataFrame:
    return blocked.groupBy("rb", "cb").agg(F.count("*").alias("samples"))


def _summary(factors: DataFrame, prefix: str) -> DataFrame:
    return factors.groupBy("key").agg(
        F.count("*").alias(f"{prefix}_rows"),
        F.min("id").alias(f"{prefix}_first"),
        F.max("id").alias(f"{prefix}_last"),
    )


def block_factor_join(w: DataFrame, h: DataFrame) -> DataFrame:
    """Blocks that have both user and item factors. Each side is summed up before the join."""
    return _summary(w, "w").join(_summary(h, "h"), "key")


def block_data_right_join(blocked: DataFrame, wh: DataFrame) -> DataFrame:
    """Ratings per row block next to its factors; a block without ratings keeps its factors."""
    samples = blocked.groupBy(F.col("rb").alias("key")).agg(F.count("*").alias("samples"))
    return samples.join(wh, "key", "right")


def block_cogroup_counts(blocked: DataFrame, w: DataFrame, h: DataFrame) -> DataFrame:
    """Rows of the three sides that meet in each block, counted without gathering them."""
    sides = {"samples": blocked.withColumnRenamed("rb", "key"), "w_rows": w, "h_rows": h}
    tagged = [df.select("key", F.lit(side).alias("side")) for side, df in sides.items()]
    together = tagged[0].unionAll(tagged[1]).unionAll(tagged[2])
    return together.groupBy("key").agg(
        *[F.count_if(F.col("side") == side).alias(side) for side in sides]
    )
