"""Factor tables ``(role, id, vec)``: role W for rows (users), role H for columns (items)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.functions.vectors import uniform_vector
from tesselar.operators.grid import matrix_extent

AXES = {"W": "i", "H": "j"}


def init_factors(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """Uniform [0, 1) start vectors for ``(role, id)`` rows; H uses ``seed + 1``."""
    role_seed = F.when(F.col("role") == "W", seed).otherwise(seed + 1)
    vec = uniform_vector(role_seed, F.col("id"), rank)
    return ids.select("role", "id", vec.alias("vec"))


def rating_sides(ratings: DataFrame) -> DataFrame:
    """``(role, id)`` of the user and of the item of every rating, from one scan."""
    sides = [
        F.struct(F.lit(role).alias("role"), F.col(axis).alias("id")) for role, axis in AXES.items()
    ]
    return ratings.select(F.inline(F.array(*sides)))


def observed_ids(ratings: DataFrame) -> DataFrame:
    """``(role, id)`` of every user and item that has a rating."""
    return rating_sides(ratings).distinct()


def dense_ids(ratings: DataFrame) -> DataFrame:
    """``(role, id)`` of every id from 0 to the largest, rated or not."""
    spark = ratings.sparkSession
    extent = matrix_extent(ratings).first()
    roles = [
        spark.range(extent[f"max_{axis}"] + 1).select(F.lit(role).alias("role"), "id")
        for role, axis in AXES.items()
    ]
    return roles[0].unionAll(roles[1])


def fill_missing_factors(factors: DataFrame, ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """Give a fresh start vector to every ``(role, id)`` of ``ids`` that has none; each is there once."""
    missing = ids.join(factors.select("role", "id"), ["role", "id"], "left_anti")
    return factors.unionByName(init_factors(missing, rank, seed))


def factors_sorted(factors: DataFrame, role: str) -> DataFrame:
    return factors.filter(F.col("role") == role).orderBy("id")


def factors_head(factors: DataFrame, role: str, n: int = 15) -> DataFrame:
    return factors_sorted(factors, role).limit(n)
