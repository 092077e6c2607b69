"""Block index, sub-epoch and rotation arithmetic on ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def block_width(max_id: Column | int, n: int, base: int) -> Column:
    """Ids per block so that ``n`` blocks cover ``base``..``max_id``."""
    last = max_id if isinstance(max_id, Column) else F.lit(max_id)
    rounded_up = F.call_function("div", last + (n - base), F.lit(n))
    return F.greatest(rounded_up, F.lit(1))


def block_index(id_col: Column, max_id: Column | int, n: int, base: int = 0) -> Column:
    """Block of an id. With ``base=1`` ids start at 1 and id 0 stays in block 0."""
    offset = id_col if base == 0 else F.greatest(id_col - 1, F.lit(0))
    return F.call_function("div", offset, block_width(max_id, n, base)).cast("int")


STRATA = "strata"
ROW_MAJOR = "row_major"


def turn(row_block: Column, col_block: Column, n: int, schedule: str = STRATA) -> Column:
    """The sub-epoch of a block; blocks of one sub-epoch share no row block and no column block.

    Strata are the wrapped diagonals. The anti-diagonals of ``ROW_MAJOR`` give the same result as visiting the blocks
    row by row: whatever shares a row or column with a block and precedes it has an earlier turn.
    """
    if schedule == ROW_MAJOR:
        return (row_block + col_block).cast("int")
    return F.pmod(col_block - row_block, F.lit(n)).cast("int")


def meeting_row_block(col_block: Column, offset: int, n: int) -> Column:
    """The row block that column block ``col_block`` meets in stratum ``offset``."""
    return F.pmod(col_block - F.lit(offset), F.lit(n)).cast("int")
