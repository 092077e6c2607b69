"""State along an order within a key, for keys of any size, over one sorted and stored layout.

Rows are range-partitioned by key and order once and stored, one bucket a range (a chunk). A key may run through many
chunks. Every chunk is first summed up for its last key; summaries compose, and there is one a chunk, so the driver
finds the state in which each chunk is entered. Then every chunk is folded from that state, in parallel. Nothing is
shuffled after the layout.
"""

from __future__ import annotations

import pickle
from abc import ABC, abstractmethod
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselar.operators.skew import rows_of_part
from tesselar.workspace import bucket_keys, drop_table, new_path, write_buckets


class Fold(ABC):
    """A state machine over the rows of a key. States and summaries are plain Python values."""

    #: The state before the first row of a key.
    start: Any
    #: DDL of the columns that ``apply`` adds.
    shape: str

    @abstractmethod
    def summary(self, rows: pa.Table) -> Any:
        """What ``compose`` needs of consecutive rows of one key."""

    @abstractmethod
    def compose(self, state: Any, summary: Any) -> Any:
        """The state after the rows of a summary."""

    @abstractmethod
    def apply(self, rows: pa.Table, first: np.ndarray, state: Any) -> dict[str, pa.Array]:
        """The added columns of a chunk. ``first`` is for every row the place of the first row of its key in the
        chunk; the key of place 0 is entered in ``state``, every other in ``start``."""


def _key_starts(rows: pa.Table, key: list[str]) -> np.ndarray:
    """The places where another key begins; null is a key like others."""
    if not rows.num_rows:
        return np.empty(0, np.int64)
    changed = np.zeros(rows.num_rows, bool)
    changed[0] = True
    for name in key:
        codes = rows.column(name).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        changed[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(changed)


def _stored_order(chunk: pa.Table) -> pa.Table:
    chunk = chunk.combine_chunks()
    place = chunk.column("_place").to_numpy()
    return chunk if (place[1:] > place[:-1]).all() else chunk.take(pa.array(np.argsort(place)))


def _key_at(rows: pa.Table, key: list[str], place: int) -> bytes:
    return pickle.dumps(tuple(rows.column(name)[place].as_py() for name in key))


def _summaries(fold: Fold, key: list[str]) -> Callable[[pa.Table], pa.Table]:
    def run(chunk: pa.Table) -> pa.Table:
        rows = _stored_order(chunk)
        last = int(_key_starts(rows, key)[-1])
        told = (_key_at(rows, key, 0), _key_at(rows, key, rows.num_rows - 1), last == 0, fold.summary(rows.slice(last)))
        return pa.table({"chunk": pa.array([rows.column("_chunk")[0].as_py()], pa.int32()), "told": pa.array([pickle.dumps(told)], pa.binary())})

    return run


def entered(fold: Fold, told: list[tuple[int, tuple]]) -> dict[int, Any]:
    """The state in which each chunk is entered, where that is not the start, from the summaries in chunk order."""
    states, key, state = {}, None, fold.start
    for chunk, (first_key, last_key, only, summary) in told:
        before = state if first_key == key else fold.start
        if first_key == key:
            states[chunk] = state
        state = fold.compose(before if only else fold.start, summary)
        key = last_key
    return states


def fold_in_order(df: DataFrame, key: list[str], order: list[str], fold: Fold, chunks: int) -> DataFrame:
    """The rows of ``df`` with the columns that ``fold`` adds; ``order`` orders the rows of a key.

    ``chunks`` is the number of ranges. Rows that are equal in key and order may lie in any order.
    """
    spark = df.sparkSession
    keys, names = bucket_keys(spark, chunks), df.columns
    ranged = df.repartitionByRange(chunks, *key, *order).sortWithinPartitions(*key, *order)
    numbered = ranged.withColumns({"_chunk": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    numbered = numbered.withColumn("_bk", F.element_at(F.array(*[F.lit(k) for k in keys]), F.col("_chunk") + 1))
    layout = write_buckets(numbered, new_path(spark, "ordered"), chunks, "_bk")
    stored = layout.read()
    found = stored.groupBy("_bk").applyInArrow(_summaries(fold, key), "chunk int, told binary").collect()
    states = entered(fold, sorted((row["chunk"], pickle.loads(row["told"])) for row in found))

    def run(chunk: pa.Table) -> pa.Table:
        rows = _stored_order(chunk)
        starts = _key_starts(rows, key)
        first = np.repeat(starts, np.diff(np.append(starts, rows.num_rows)))
        state = states.get(rows.column("_chunk")[0].as_py(), fold.start)
        added = fold.apply(rows, first, state)
        return pa.table({**{name: rows.column(name) for name in names}, **added})

    shape = ", ".join([*[f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema.fields], fold.shape])
    # The plan holds the files of the layout; the catalog need not.
    folded = stored.groupBy("_bk").applyInArrow(run, shape)
    drop_table(layout)
    return folded


def chunks_for(spark: SparkSession, rows: int, rows_per_chunk: int) -> int:
    """Ranges of about ``rows_per_chunk`` rows for ``rows`` hot rows, larger where these are many, and enough for the rest."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_of_part(rows, rows_per_chunk)))


def since(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Running sum of ``values`` from the place ``first`` of every row."""
    total = np.cumsum(values)
    return total - (total[first] - values[first]) if len(values) else total


def last_place(marked: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every row the last marked place up to it within its key, or the place before the key's first row."""
    place = np.where(marked, np.arange(len(marked)), -1)
    return np.maximum(np.maximum.accumulate(place), first - 1) if len(marked) else place
