"""Hot keys: finding them, and joining on them without one task holding a whole key.

A key is hot when it holds more rows than one task should take; every such key is split, null keys like
others. The list of hot keys is a table; it is broadcast only while it has at most ``BROADCAST_KEYS`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselar.workspace import materialize

ROWS_PER_TASK = 4_000_000
#: Ratings of a sub-block that a Python task levels, learns or measures at once.
ROWS_PER_BLOCK = 1_000_000
#: Parts that rows are cut into, unless they need more to fit ``ROWS_PER_TASK``: a part costs a task and a file.
PARTS = 256
BROADCAST_KEYS = 16_384


@dataclass(frozen=True)
class HotKeys:
    """The keys to split, as a table with ``key_rows`` (None when there are none), and their rows in all."""

    columns: tuple[str, ...]
    rows: int
    table: DataFrame | None
    keys: int = 0

    def __bool__(self) -> bool:
        return self.table is not None

    def to_join(self, *columns: Column | str) -> DataFrame:
        """Columns of the table, to be joined by the key: sent to every task if they are few."""
        chosen = self.table.select(*columns)
        return F.broadcast(chosen) if self.keys <= BROADCAST_KEYS else chosen


def rows_of_part(rows: int, wanted: int, largest: int = ROWS_PER_TASK, parts: int = PARTS) -> int:
    """Rows of a part of ``rows`` rows: as many as wanted, or more where that made above ``parts`` parts. Only above
    ``largest`` rows a part does the number of parts grow with the rows."""
    return max(wanted, min(largest, -(-rows // parts)))


def null_safe_join(left: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """Join on equal keys, null with null. The key columns are those of ``left``."""
    a, b = left.alias("_l"), right.alias("_r")
    same = reduce(Column.__and__, [F.col(f"_l.{name}").eqNullSafe(F.col(f"_r.{name}")) for name in key])
    joined = a.join(b, same, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select("_l.*", *[F.col(f"_r.{name}") for name in right.columns if name not in key])


def hot_keys_of(counts: DataFrame, key: list[str], rows_per_task: int = ROWS_PER_TASK) -> HotKeys:
    """The hot keys among counted keys; ``counts`` has the key columns and ``key_rows``."""
    largest = counts.filter(F.col("key_rows") > rows_per_task)
    found = largest.agg(F.count("*").alias("keys"), F.sum("key_rows").alias("rows")).first()
    if not found["keys"]:
        return HotKeys(tuple(key), 0, None)
    return HotKeys(tuple(key), found["rows"], materialize(largest, "hot-keys"), found["keys"])


def find_hot_keys(df: DataFrame, key: list[str], rows_per_task: int = ROWS_PER_TASK) -> HotKeys:
    """One counting job over the key columns; the counts combine before the shuffle."""
    counts = df.groupBy(*key).agg(F.count("*").alias("key_rows"))
    return hot_keys_of(counts, key, rows_per_task)


def _parts(rows_per_task: int) -> Column:
    return F.ceil(F.col("key_rows") / rows_per_task).cast("int")


def skew_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: list[str],
    spread: list[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join ``facts`` to a ``lookup`` with few rows per key.

    A hot key is cut into as many parts as it has task-sized shares: its facts pick a part by the
    hash of ``spread``, its lookup rows go to every part. Other keys join as usual.
    """
    hot = find_hot_keys(facts, key, rows_per_task) if hot is None else hot
    if not hot:
        return facts.join(lookup, key, how)
    parts = hot.to_join(*key, _parts(rows_of_part(hot.rows, rows_per_task)).alias("_parts"))
    part_of_fact = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")), F.lit(0)).cast("int")
    salted_facts = null_safe_join(facts, parts, key, "left").withColumn("_part", part_of_fact).drop("_parts")
    every_part = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    salted_lookup = null_safe_join(lookup, parts, key, "left").withColumn("_part", every_part).drop("_parts")
    return salted_facts.join(salted_lookup, [*key, "_part"], how).drop("_part")
