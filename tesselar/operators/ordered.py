"""Running totals over an order within a key, with hot keys cut into chunks of the order.

``Window.partitionBy(key).orderBy(...)`` puts every row of a key in one task. Here the rows of hot keys are
range-partitioned by key and order and written once; the window then runs per (key, chunk), and each
chunk adds what the chunks before it carry over. Chunk totals are plain aggregates with one row per chunk.
Without hot keys the plan is the plain window. Null keys are keys like others on both ways.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselar.operators.skew import ROWS_PER_TASK, HotKeys, find_hot_keys, null_safe_join, rows_of_part
from tesselar.workspace import materialize

CHUNK = "_chunk"


@dataclass(frozen=True)
class Chunked:
    """Rows with a ``CHUNK`` column that grows with the order inside every key."""

    df: DataFrame
    key: list[str]
    order: list[str]
    hot: HotKeys

    def with_df(self, df: DataFrame) -> "Chunked":
        return Chunked(df, self.key, self.order, self.hot)

    def hot_rows(self) -> DataFrame:
        return self.df.filter(F.col(CHUNK) > 0)


def chunk(
    df: DataFrame, key: list[str], order: list[str], rows_per_chunk: int = ROWS_PER_TASK, largest: int = ROWS_PER_TASK
) -> Chunked:
    """Cut the hot keys of ``df`` by the whole order; only rows equal in all of it share a chunk for sure.

    Chunks of hot keys count from 1, the rows of other keys are chunk 0. Many rows are cut into larger chunks, up to
    ``largest`` rows, instead of ever more (``skew.rows_of_part``).
    """
    hot = find_hot_keys(df, key, rows_per_chunk)
    if not hot:
        return Chunked(df.withColumn(CHUNK, F.lit(0)), key, order, hot)
    names = hot.to_join(*key)
    parts = math.ceil(hot.rows / rows_of_part(hot.rows, rows_per_chunk, largest))
    ranged = null_safe_join(df, names, key, "left_semi").repartitionByRange(parts, *key, *order)
    # Written, so that every later step sees the same cuts.
    cut = materialize(ranged.withColumn(CHUNK, F.spark_partition_id() + 1), "chunks")
    rest = null_safe_join(df, names, key, "left_anti").withColumn(CHUNK, F.lit(0))
    return Chunked(rest.unionByName(cut), key, order, hot)


def plain(df: DataFrame, key: list[str], order: list[str]) -> Chunked:
    """Rows of keys that are known to fit a task each."""
    return Chunked(df.withColumn(CHUNK, F.lit(0)), key, order, HotKeys(tuple(key), 0, None))


def chunk_window(chunked: Chunked):
    return Window.partitionBy(*chunked.key, CHUNK).orderBy(*chunked.order)


def running(
    chunked: Chunked, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None
) -> Chunked:
    """Add inclusive running sums and maxima per key along the order."""
    sums, maxima = sums or {}, maxima or {}
    so_far = chunk_window(chunked).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = chunked.df.withColumns(
        {name: F.sum(value).over(so_far) for name, value in sums.items()}
        | {name: F.max(value).over(so_far) for name, value in maxima.items()}
    )
    if not chunked.hot:
        return chunked.with_df(local)
    totals = chunked.hot_rows().groupBy(*chunked.key, CHUNK).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()],
        *[F.max(value).alias(name) for name, value in maxima.items()],
    )
    earlier = Window.partitionBy(*chunked.key).orderBy(CHUNK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = totals.select(
        *chunked.key,
        CHUNK,
        *[F.sum(name).over(earlier).alias(f"_carry_{name}") for name in sums],
        *[F.max(name).over(earlier).alias(f"_carry_{name}") for name in maxima],
    )
    joined = null_safe_join(local, carry, [*chunked.key, CHUNK], "left")
    whole = joined.withColumns(
        {name: F.col(name) + F.coalesce(F.col(f"_carry_{name}"), F.lit(0)) for name in sums}
        | {name: F.greatest(F.col(name), F.col(f"_carry_{name}")) for name in maxima}
    )
    return chunked.with_df(whole.drop(*[f"_carry_{name}" for name in [*sums, *maxima]]))


def trailing(chunked: Chunked, value: Column, n: int, out: str) -> Chunked:
    """Add an array of the values of the latest up to ``n`` rows per key, the current row last.

    A null value takes one of the ``n`` places and is then left out.
    """
    here = chunk_window(chunked)
    # In a struct, a null is collected too.
    latest = F.collect_list(F.struct(value.alias("value"))).over(here.rowsBetween(1 - n, Window.currentRow))
    local = chunked.df.withColumn(out, latest)
    known = F.filter(F.transform(out, lambda row: row["value"]), lambda item: item.isNotNull())
    if not chunked.hot or n == 1:
        return chunked.with_df(local.withColumn(out, known))
    backwards = Window.partitionBy(*chunked.key, CHUNK).orderBy(
        *[F.desc(column) for column in chunked.order]
    )
    tail = F.struct(F.col("_back"), value.alias("value"))
    tails = (
        chunked.hot_rows()
        .withColumn("_back", -F.row_number().over(backwards))
        .filter(F.col("_back") > -n)
        .groupBy(*chunked.key, CHUNK)
        .agg(F.transform(F.sort_array(F.collect_list(tail)), lambda t: F.struct(t["value"].alias("value"))).alias("_tail"))
    )
    # Every chunk holds at least one row, so the n-1 chunks before hold the n-1 values needed.
    earlier = Window.partitionBy(*chunked.key).orderBy(CHUNK).rowsBetween(1 - n, -1)
    carry = tails.select(
        *chunked.key, CHUNK, F.flatten(F.collect_list("_tail").over(earlier)).alias("_before")
    )
    joined = null_safe_join(local, carry, [*chunked.key, CHUNK], "left")
    both = F.concat(F.coalesce(F.col("_before"), F.array().cast(local.schema[out].dataType)), out)
    start = F.greatest(F.size(both) - n, F.lit(0)) + 1
    whole = joined.withColumn(out, F.slice(both, start, n)).drop("_before")
    return chunked.with_df(whole.withColumn(out, known))


def finish(chunked: Chunked) -> DataFrame:
    return chunked.df.drop(CHUNK)


def key_totals(
    chunked: Chunked, sums: dict[str, Column] | None = None, minima: dict[str, Column] | None = None
) -> Chunked:
    """Add sums and minima over all rows of the key to each of its rows."""
    sums, minima = sums or {}, minima or {}
    aggregates = {name: F.sum(value) for name, value in sums.items()}
    aggregates |= {name: F.min(value) for name, value in minima.items()}
    here = Window.partitionBy(*chunked.key, CHUNK)
    local = chunked.df.withColumns({name: agg.over(here) for name, agg in aggregates.items()})
    if not chunked.hot:
        return chunked.with_df(local)
    per_chunk = chunked.hot_rows().groupBy(*chunked.key, CHUNK).agg(
        *[agg.alias(name) for name, agg in aggregates.items()]
    )
    whole = Window.partitionBy(*chunked.key)
    overall = per_chunk.select(
        *chunked.key,
        CHUNK,
        *[F.sum(name).over(whole).alias(f"_all_{name}") for name in sums],
        *[F.min(name).over(whole).alias(f"_all_{name}") for name in minima],
    )
    joined = null_safe_join(local, overall, [*chunked.key, CHUNK], "left")
    merged = joined.withColumns(
        {name: F.coalesce(F.col(f"_all_{name}"), F.col(name)) for name in aggregates}
    )
    return chunked.with_df(merged.drop(*[f"_all_{name}" for name in aggregates]))
