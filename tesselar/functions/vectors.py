"""Expressions on factor vectors."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13  # 52 bits, which a double holds exactly


def uniform_value(seed: Column, id_col: Column, position: Column) -> Column:
    """A value in [0, 1) that depends on (seed, id, position) only, never on partitioning."""
    digest = F.md5(F.concat_ws(":", *[part.cast("string") for part in (seed, id_col, position)]))
    digits = F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10)
    return digits.cast("double") / F.lit(float(16**HEX_DIGITS))


def uniform_vector(seed: Column, id_col: Column, rank: int) -> Column:
    return F.array(*[uniform_value(seed, id_col, F.lit(position)) for position in range(rank)])


def dot(left: str, right: str, rank: int | None = None) -> Column:
    """Dot product of two array columns; with a known rank the sum compiles to plain arithmetic."""
    if rank is None:
        products = F.zip_with(left, right, lambda x, y: x * y)
        return F.aggregate(products, F.lit(0.0), lambda total, product: total + product)
    return reduce(add, [F.col(left)[k] * F.col(right)[k] for k in range(rank)])


def joined_values(vec: Column, digits: int | None = None) -> Column:
    """Vector as comma-joined text; ``digits`` fixes the decimals, default is the full double."""
    def as_text(value: Column) -> Column:
        if digits is None:
            return value.cast("string")
        return F.round(value, digits).cast(f"decimal({18 + digits},{digits})").cast("string")

    return F.array_join(F.transform(vec, as_text), ",")
