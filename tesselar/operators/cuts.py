"""Strips of the block grid: contiguous id ranges of about equal weight, and the turn of every pair of strips.

A block of the grid is cut along both axes where the ratings lie, not at equal ids: row strips and column strips are
quantiles of the id histograms, and each axis has the number that it needs. Learning sub-blocks by anti-diagonals gives the
same result as learning the whole block in (i, j, r) order, so cuts change no model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.functions.grid import ROW_MAJOR
from tesselar.operators.factors import rating_sides
from tesselar.operators.grid import Grid
from tesselar.operators.skew import ROWS_PER_BLOCK, rows_of_part
from tesselar.workspace import materialize

#: Ranges of an axis that are counted at once, and parts that a heavy one is cut into, as powers of two.
RANGE_BITS, FINER_BITS = 12, 6
#: Sub-blocks that ratings are cut into, unless they need more to fit ``ROWS_PER_BLOCK``: every strip makes turns longer.
SUB_BLOCKS = 64
#: A sub-block may hold so many times ``ROWS_PER_BLOCK``; times that thinner strips are tried.
SLACK, TRIES = 1.5, 4


def id_counts(ratings: DataFrame) -> DataFrame:
    """``role``, ``id``, ``rows`` of every user and item, written, from one scan of the ratings."""
    return materialize(rating_sides(ratings).groupBy("role", "id").agg(F.count("*").alias("rows")), "id-counts")


def _width(largest: int, n: int, base: int) -> int:
    return max((largest + n - base) // n, 1)


@dataclass(frozen=True)
class Cuts:
    """The first ids of the row strips and of the column strips of a grid, ascending; every block starts a strip.

    ``cells`` are the sub-blocks that hold ratings (row strip times column strips, plus column strip); without them any
    may. The others wait for nothing and nothing waits for them. In ``any_order``, which is enough to measure, a sub-block
    takes the first turn that is free in both its strips.
    """

    grid: Grid
    rows: tuple[int, ...]
    cols: tuple[int, ...]
    cells: tuple[int, ...] | None = None
    any_order: bool = False

    @classmethod
    def whole_blocks(cls, grid: Grid) -> "Cuts":
        return cls(grid, *(_block_starts(grid, largest) for largest in (grid.max_i, grid.max_j)))

    @staticmethod
    def strip(starts: tuple[int, ...], ids: np.ndarray) -> np.ndarray:
        return np.maximum(np.searchsorted(np.array(starts), ids, "right") - 1, 0)

    def _blocks(self, starts: tuple[int, ...], largest: int) -> np.ndarray:
        width = _width(largest, self.grid.n, self.grid.base)
        return np.maximum(np.array(starts) - self.grid.base, 0) // width

    @cached_property
    def row_blocks(self) -> np.ndarray:
        """The block of every row strip."""
        return self._blocks(self.rows, self.grid.max_i)

    @cached_property
    def col_blocks(self) -> np.ndarray:
        return self._blocks(self.cols, self.grid.max_j)

    @cached_property
    def _firsts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The first strip of every block and its strips, of rows and of columns."""
        n = self.grid.n
        found = []
        for blocks in (self.row_blocks, self.col_blocks):
            found += [np.searchsorted(blocks, np.arange(n)), np.bincount(blocks, minlength=n)]
        return tuple(found)

    @cached_property
    def _schedule(self) -> tuple[np.ndarray, np.ndarray]:
        """The turn of every sub-block (-1: none), and the first turn of every stratum with the number of turns.

        A sub-block follows those before it in its row strip and in its column strip at once. A stratum has a turn at
        least, in which items are at their blocks. Row by row all is one stratum.
        """
        n_cols = len(self.cols)
        cells = np.arange(len(self.rows) * n_cols) if self.cells is None else np.array(self.cells, np.int64)
        row, col = cells // n_cols, cells % n_cols
        n = 1 if self._one_stratum else self.grid.n
        strata = (self.col_blocks[col] - self.row_blocks[row]) % n
        turns, starts = np.full((len(self.rows), n_cols), -1), [0]
        for stratum in range(n):
            inside = np.flatnonzero(strata == stratum)
            inside = inside[np.lexsort((col[inside], row[inside]))]
            row_free, col_free, length = [0] * len(self.rows), [0] * n_cols, 1
            for r, c in zip(row[inside].tolist(), col[inside].tolist()):
                if self.any_order:
                    # Bits of the turns that are taken.
                    taken = row_free[r] | col_free[c]
                    at = (~taken & (taken + 1)).bit_length() - 1
                    row_free[r] |= 1 << at
                    col_free[c] |= 1 << at
                else:
                    at = max(row_free[r], col_free[c])
                    row_free[r] = col_free[c] = at + 1
                turns[r, c] = starts[-1] + at
                length = max(length, at + 1)
            starts.append(starts[-1] + length)
        return turns, np.array(starts)

    @property
    def _one_stratum(self) -> bool:
        return self.any_order or self.grid.schedule == ROW_MAJOR

    @property
    def turns(self) -> int:
        return int(self._schedule[1][-1])

    def stratum_turns(self, stratum: int) -> range:
        """The turns in which the blocks of a stratum are learned."""
        starts = self._schedule[1]
        return range(int(starts[stratum]), int(starts[stratum + 1]))

    def turn(self, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """The turn of the sub-blocks of row strips and column strips; those of one turn share no strip."""
        return self._schedule[0][row, col]

    def met_by(self, turn: int) -> np.ndarray:
        """For every column strip the row strip that it meets in ``turn``, or waits at: those that wait are dealt evenly
        over the row strips, of the block that theirs meets."""
        turns, starts = self._schedule
        col = np.arange(len(self.cols))
        if self._one_stratum:
            met = col % len(self.rows)
        else:
            row_first, n_rows, col_first, _ = self._firsts
            stratum = int(np.searchsorted(starts, turn, "right")) - 1
            row_block = (self.col_blocks - stratum) % self.grid.n
            met = row_first[row_block] + (col - col_first[self.col_blocks]) % n_rows[row_block]
        row, here = np.nonzero(turns == turn)
        met[here] = row
        return met


def _block_starts(grid: Grid, largest: int) -> tuple[int, ...]:
    """The first ids of all blocks; the first one also holds the ids below the base."""
    width = _width(largest, grid.n, grid.base)
    return (0, *(grid.base + block * width for block in range(1, grid.n)))


def _strip_starts(counts: DataFrame, starts: tuple[int, ...], largest: int, weight: float) -> tuple[int, ...]:
    """Cut the ranges between ``starts`` into strips of about ``weight`` ratings; an id is never cut.

    The histogram has ``2 ** RANGE_BITS`` ranges and is refined only where a range is heavier than ``weight``, so what
    reaches the driver depends on the number of strips, not of ids.
    """
    bits = max(0, largest.bit_length() - RANGE_BITS)
    pieces: list[tuple[int, int]] = []
    rest = counts
    while True:
        ranges = rest.groupBy(F.shiftright("id", bits).alias("range")).agg(F.sum("rows").alias("rows")).collect()
        heavy = [row["range"] for row in ranges if row["rows"] > weight and bits]
        pieces += [(row["range"] << bits, row["rows"]) for row in ranges if not (row["rows"] > weight and bits)]
        if not heavy:
            break
        wanted = counts.sparkSession.createDataFrame([(number,) for number in heavy], "range LONG")
        rest = rest.withColumn("range", F.shiftright("id", bits)).join(wanted, "range", "left_semi").select("id", "rows")
        bits = max(0, bits - FINER_BITS)
    cuts, blocks = set(starts), np.array(starts)
    filled, last_block = 0, -1
    for start, rows in sorted(pieces):
        block = int(np.searchsorted(blocks, start, "right")) - 1
        if block != last_block:
            filled, last_block = 0, block
        elif filled and filled + rows > weight:
            cuts.add(start)
            filled = 0
        filled += rows
    return tuple(sorted(cuts))


def _cell_rows(ratings: DataFrame, cuts: Cuts) -> dict[int, int]:
    """Ratings of every sub-block that has some, from one scan; what reaches the driver depends on the strips alone."""
    size = len(cuts.rows) * len(cuts.cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros(size, np.int64)
        for batch in batches:
            row, col = (cuts.strip(starts, batch.column(axis).to_numpy()) for starts, axis in ((cuts.rows, "i"), (cuts.cols, "j")))
            rows += np.bincount(row * len(cuts.cols) + col, minlength=size)
        cells = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(rows[cells])], ["cell", "rows"])

    known = ratings.select("i", "j").where(F.col("i").isNotNull() & F.col("j").isNotNull())
    found = known.mapInArrow(run, "cell LONG, rows LONG").groupBy("cell").agg(F.sum("rows").alias("rows"))
    return {row["cell"]: row["rows"] for row in found.collect()}


def fitting_cuts(grid: Grid, counts: DataFrame, rows_per_block: int = ROWS_PER_BLOCK, ratings: DataFrame | None = None) -> Cuts:
    """Cuts that keep sub-blocks to about ``rows_per_block`` ratings, or more where that made above ``SUB_BLOCKS``.

    A row strip of weight a and a column strip of weight b share about a * b / all ratings, if the ratings of a user
    lie anywhere. Both are cut at the square root of all * rows_per_block; where an id alone is heavier than that, the
    strips of the other axis are as much lighter. Samples of one id are learned one after the other, so only the other
    axis can cut them.

    With the ``ratings`` the sub-blocks are counted. Where groups of users keep to their own items, few sub-blocks hold
    most ratings: strips are cut thinner until none is far above ``ROWS_PER_BLOCK``, and empty ones get no turn.
    """
    whole = Cuts.whole_blocks(grid)
    sizes = {row["role"]: row for row in counts.groupBy("role").agg(F.sum("rows").alias("all"), F.max("rows").alias("largest")).collect()}
    if not sizes or sizes["W"]["all"] <= rows_per_block:
        return whole
    rows = sizes["W"]["all"]
    area = rows * rows_of_part(rows, rows_per_block, ROWS_PER_BLOCK, SUB_BLOCKS)

    def cut(thinner: float) -> Cuts:
        starts = []
        for role, other, blocks, largest in (("W", "H", whole.rows, grid.max_i), ("H", "W", whole.cols, grid.max_j)):
            weight = area / max(sizes[other]["largest"], math.sqrt(area)) / thinner
            known = counts.where((F.col("role") == role) & F.col("id").isNotNull())
            starts.append(_strip_starts(known.select("id", "rows"), blocks, largest, weight))
        return Cuts(grid, *starts)

    cuts, thinner = cut(1.0), 1.0
    if ratings is None:
        return cuts
    cells = _cell_rows(ratings, cuts)
    for _ in range(TRIES):
        heaviest = max(cells.values(), default=0) / ROWS_PER_BLOCK
        if heaviest <= SLACK:
            break
        thinner *= heaviest
        finer = cut(thinner)
        if finer == cuts:
            break
        cuts, cells = finer, _cell_rows(ratings, finer)
    return replace(cuts, cells=tuple(sorted(cells)))
