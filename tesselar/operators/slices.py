"""Stratified SGD in any order of samples, on stored slices of that order.

A block whose samples have an order of their own, such as the line number, cannot be cut along its axes: a user's
samples would change between sub-blocks all the time. It is cut along the order instead. The slices of a block are
learned one after the other, those of the blocks of one turn in parallel, and a task holds one slice with the vectors
of its ids.

Vectors travel: every vector carries the turns in which its id has samples, as bits, and is written for the next of
them, packed with others that go the same way. A turn reads what was written for it bucket by bucket and no other
vector; nothing is shuffled, and no vector is written more often than its id has slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesselar.operators.cuts import Cuts
from tesselar.operators.dsgd import IN_ORDER, Layout, _learn, _Side, _stored_vectors, _sub_blocks, cell_errors, checked_ratings, sample_levels
from tesselar.operators.skew import rows_of_part
from tesselar.workspace import append_buckets, bucket_keys, drop_partition, drop_table, new_path, write_buckets

#: Numbers in the user vectors of a slice, if all its samples had users of their own: a task holds up to two vectors a sample.
SLICE_VALUES = 2_000_000
SLICE_SCHEMA = "unit LONG, bk INT, rs INT, cs INT, lvl LONG, i LONG, j LONG, r DOUBLE"
PACKED_SCHEMA = "step LONG, bk INT, role STRING, ids BINARY, vecs BINARY, visits BINARY"
#: Bytes of the vectors that are packed into one row, and rows that are sent at once: a batch of Spark's, which has up to
#: 10,000 rows or 64 MB, is buffered several times outside of the heap. Vectors that are packed at once before the first turn.
PACK_BYTES, BATCH_ROWS, PACK_ROWS = 1 << 10, 1 << 12, 1 << 17
#: The step before the first one, and that of vectors whose ids have no samples.
NEVER = -1
WORD = 64


def rows_per_slice(rank: int) -> int:
    return max(1, SLICE_VALUES // max(1, rank))


@dataclass(frozen=True)
class Slices(Layout):
    """Stored samples in slices of their order; strips are those of ``cuts``, which only measure.

    ``units`` are the stored parts of every turn, one for each row block at most, and ``strata`` the turn of the whole
    blocks that each turn is part of.
    """

    whole: Cuts
    units: tuple[tuple[int, ...], ...]
    strata: tuple[int, ...]

    @property
    def turns(self) -> int:
        return len(self.units)

    def turn(self, turn: int) -> DataFrame:
        return self.samples.where(F.col("unit").isin(*self.units[turn]))

    def turn_of_units(self) -> DataFrame:
        rows = [(unit, turn) for turn, units in enumerate(self.units) for unit in units]
        return self.table.spark.createDataFrame(rows, "unit LONG, turn INT")


def _placed(cuts: Cuts, whole: Cuts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(axis).to_numpy() for axis in ("i", "j")]
            rs, cs, rb, cb = (part.strip(starts, x) for part in (cuts, whole) for starts, x in zip((part.rows, part.cols), ids))
            added = {"s": whole.turn(rb, cb), "rb": rb, "rs": rs, "cs": cs}
            columns = [pa.array(values.astype(np.int32)) for values in added.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *added])

    return run


def _add_levels(whole: Cuts, keys: tuple[int, ...]):
    """Level and unit of samples in order; a partition holds a slice of one block or, where blocks meet, of some."""
    names = [field.split()[0] for field in SLICE_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _sub_blocks(batches, "s", "rb"):
            s, rb, piece = (part.column(name)[0].as_py() for name in ("s", "rb", "piece"))
            n = part.num_rows
            added = {
                "unit": np.full(n, (piece * whole.turns + s) * len(keys) + rb),
                "bk": np.full(n, keys[rb], np.int32),
                "lvl": sample_levels(part.column("i").to_numpy(), part.column("j").to_numpy()),
            }
            for name, values in added.items():
                part = part.append_column(name, pa.array(values))
            yield from part.select(names).to_batches()

    return run


def slice_layout(ratings: DataFrame, cuts: Cuts, order: tuple[str, ...], rows: int, wanted: int, largest: int) -> Slices:
    """Store ``rows`` ratings in slices of about ``wanted``, cut at quantiles of the order, by one shuffle.

    Where that made too many slices they are larger, up to about ``largest``. Samples that ``order`` does not tell apart follow in (i, j, r) order. A null id or rating raises.
    """
    spark = ratings.sparkSession
    whole = Cuts.whole_blocks(cuts.grid)
    keys = bucket_keys(spark, len(whole.rows))
    complete_rows = checked_ratings(ratings, order)
    schema = T.StructType([*complete_rows.schema.fields, *[T.StructField(name, T.IntegerType()) for name in ("s", "rb", "rs", "cs")]])
    placed = complete_rows.mapInArrow(_placed(cuts, whole), schema)
    by = ["s", "rb", *order, *[name for name in IN_ORDER if name not in order]]
    pieces = -(-rows // rows_of_part(rows, min(wanted, largest), largest))
    ordered = placed.repartitionByRange(pieces, *by).sortWithinPartitions(*by)
    sliced = ordered.select("s", "rb", "rs", "cs", *IN_ORDER, F.spark_partition_id().alias("piece"))
    levelled = sliced.mapInArrow(_add_levels(whole, keys), SLICE_SCHEMA)
    table = write_buckets(levelled, new_path(spark, "slices"), len(keys), "bk", partition_by="unit", sort_by="lvl")
    # The slices of a block in order; those of a stratum at the same place have the same turn.
    turns: dict[tuple[int, int], list[int]] = {}
    seen: dict[int, int] = {}
    for unit in sorted(row["unit"] for row in table.read().select("unit").distinct().collect()):
        block = unit % (whole.turns * len(keys))
        place = seen[block] = seen.get(block, -1) + 1
        turns.setdefault((block // len(keys), place), []).append(unit)
    found = sorted(turns)
    return Slices(table, cuts, keys, whole, tuple(tuple(turns[at]) for at in found), tuple(stratum for stratum, _ in found))


def _next_steps(visits: np.ndarray, step: int, turns: int) -> np.ndarray:
    """The step after ``step`` whose turn has its bit set, for every row; steps go on counting from epoch to epoch."""
    turn = step % turns
    later = visits.copy()
    word, bit = divmod(turn + 1, WORD)
    later[:, :word] = 0
    if word < later.shape[1]:
        later[:, word] &= np.uint64((~0 << bit) & (1 << WORD) - 1)
    again = ~later.any(axis=1)
    later[again] = visits[again]
    first = (later != 0).argmax(axis=1)
    bits = later[np.arange(len(later)), first]
    lowest = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1))
    return np.where(bits == 0, NEVER, step - turn + first * WORD + lowest + again * turns)


class _Routes:
    """The next step of a vector and its bucket key there."""

    def __init__(self, layout: Slices):
        self.whole, self.keys, self.turns = layout.whole, np.array(layout.keys), layout.turns
        # For every turn the row block that each column block meets.
        self.met = np.array([self.whole.met_by(stratum) for stratum in layout.strata])

    def packed(self, role: str, ids: np.ndarray, rows: np.ndarray, visits: np.ndarray, step: int) -> pa.Table:
        """Rows of ``PACKED_SCHEMA``: the vectors after ``step``, by the step and bucket that they go to."""
        following = _next_steps(visits, step, self.turns)
        if role == "W":
            block = self.whole.strip(self.whole.rows, ids)
        else:
            block = self.met[following % self.turns, self.whole.strip(self.whole.cols, ids)]
        order = np.lexsort((block, following))
        following, block = following[order], block[order]
        starts = np.flatnonzero(np.diff(following, prepend=NEVER - 1) | np.diff(block, prepend=-1))
        most = max(1, PACK_BYTES // max(1, rows[:1].nbytes))
        edges = [at for start, end in zip(starts, [*starts[1:], len(ids)]) for at in range(start, end, most)]
        at = np.array(edges, np.int64)
        return pa.table({
            "step": pa.array(following[at].astype(np.int64)),
            "bk": pa.array(self.keys[block[at]].astype(np.int32)),
            "role": pa.array([role] * len(at), pa.string()),
            "ids": _bytes(ids[order], at),
            "vecs": _bytes(rows[order], at),
            "visits": _bytes(visits[order], at),
        })


def _bytes(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of the rows of ``values`` from every start to the next, without a copy."""
    values = np.ascontiguousarray(values)
    ends = np.append(starts, len(values)) * (values.nbytes // max(1, len(values)))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, one after the other and without a copy, and how many each row has."""
    _, offsets, values = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(values, np.uint8)[ends[0] : ends[-1]].view(kind), np.diff(ends) // np.dtype(kind).itemsize


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every vector of a batch the row that it is packed in, its id and the vector."""
    ids, sizes = _numbers(batch.column("ids"), np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), ids, _numbers(batch.column("vecs"), float)[0].reshape(len(ids), -1)


class _Arrived(_Side):
    """The vectors of one role that were written for a step and bucket, by id, with their turns."""

    def __init__(self, role: str, stored: pa.Table):
        self.role = role
        parts = []
        for batch in stored.to_batches():
            if batch.num_rows:
                row, ids, vectors = _unpacked(batch)
                visits = _numbers(batch.column("visits"), np.uint64)[0].reshape(len(ids), -1)
                mine = np.flatnonzero(pc.equal(batch.column("role"), role).to_numpy(zero_copy_only=False)[row])
                parts.append((mine, ids, vectors, visits))
        ids = np.concatenate([np.empty(0, np.int64), *[ids[mine] for mine, ids, _, _ in parts]])
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids = ids[order]
        widths = [values.shape[1] for values in parts[0][2:]] if parts else [0, 0]
        self.rows, self.visits = np.empty((len(ids), widths[0])), np.empty((len(ids), widths[1]), np.uint64)
        start = 0
        for mine, _, vectors, visits in parts:
            to = place[start : start + len(mine)]
            self.rows[to], self.visits[to] = vectors[mine], visits[mine]
            start += len(mine)


def _step_kernel(routes: _Routes, step: int, eta: float, sequential: bool):
    def run(samples: pa.Table, stored: pa.Table) -> pa.Table:
        w, h = _Arrived("W", stored), _Arrived("H", stored)
        if samples.num_rows:
            _learn(w, h, samples, eta, sequential)
        packed = []
        for side in (w, h):
            packed.append(routes.packed(side.role, side.ids, side.rows, side.visits, step))
            # One copy of a vector less while the other role is packed.
            side.rows = side.visits = None
        return pa.Table.from_batches([batch for table in packed for batch in table.to_batches(BATCH_ROWS)], packed[0].schema)

    return run


def _pack_first(routes: _Routes, words: list[str]):
    """Pack the rows of a partition for their first turns, many at once."""

    def packed(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        for role in ("W", "H"):
            mine = table.filter(pc.equal(table.column("role"), role)).combine_chunks()
            if mine.num_rows:
                vectors = mine.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                visits = np.stack([mine.column(word).to_numpy() for word in words], axis=1).view(np.uint64)
                yield from routes.packed(role, mine.column("id").to_numpy(), vectors.reshape(mine.num_rows, -1), visits, NEVER).to_batches(BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in batches:
            parts.append(batch)
            rows += batch.num_rows
            if rows >= PACK_ROWS:
                yield from packed(parts)
                parts, rows = [], 0
        if rows:
            yield from packed(parts)

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            row, ids, vectors = _unpacked(batch)
            yield pa.RecordBatch.from_arrays([batch.column("role").take(pa.array(row)), pa.array(ids), _stored_vectors(ids, vectors)], ["role", "id", "vec"])


def _visits(layout: Slices) -> tuple[DataFrame, list[str]]:
    """``role``, ``id`` and, as bits of the word columns, the turns in which every id has samples."""
    words = [f"word{number}" for number in range(-(-layout.turns // WORD))]
    turns = layout.samples.select("unit", "i", "j").join(F.broadcast(layout.turn_of_units()), "unit")
    sides = turns.select("turn", F.inline(F.array(*[F.struct(F.lit(role).alias("role"), F.col(axis).alias("id")) for role, axis in (("W", "i"), ("H", "j"))])))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("turn", F.lit(WORD)).cast("int"))
    inside = [F.when(F.call_function("div", F.col("turn"), F.lit(WORD)) == number, bit).otherwise(F.lit(0).cast("long")) for number in range(len(words))]
    return sides.groupBy("role", "id").agg(*[F.bit_or(value).alias(word) for word, value in zip(words, inside)]), words


class TravellingFactors:
    """Factors packed for the step in which they are needed next: turns are counted on from epoch to epoch.

    What a step has read is deleted once its vectors are written.
    """

    def __init__(self, layout: Slices, factors: DataFrame):
        self.layout, self.routes, self.step = layout, _Routes(layout), 0
        visits, words = _visits(layout)
        known = factors.select("role", F.col("id").cast("long").alias("id"), "vec").join(visits, ["role", "id"], "left")
        known = known.select("role", "id", "vec", *[F.coalesce(word, F.lit(0).cast("long")).alias(word) for word in words])
        packed = known.mapInArrow(_pack_first(self.routes, words), PACKED_SCHEMA).repartition("step", "bk")
        path = new_path(factors.sparkSession, "factors")
        self.table = write_buckets(packed, path, layout.buckets, "bk", partition_by="step", compression="none")

    def updated(self, eta: float, update: str = "simultaneous") -> DataFrame:
        """The vectors that were written for this step, after it, packed for the steps that they go to."""
        if update not in ("simultaneous", "sequential"):
            raise ValueError(f"unknown update rule {update!r}")
        samples = self.layout.turn(self.step % self.layout.turns).select("bk", "lvl", "i", "j", "r")
        stored = self.table.read().where(F.col("step") == self.step).drop("step")
        kernel = _step_kernel(self.routes, self.step, eta, update == "sequential")
        return samples.groupBy("bk").cogroup(stored.groupBy("bk")).applyInArrow(kernel, PACKED_SCHEMA)

    def learn(self, eta: float, update: str = "simultaneous") -> None:
        """One turn: its slices are learned, one of a block, and their vectors go on."""
        append_buckets(self.table, self.updated(eta, update), self.layout.buckets, "bk", "step", compression="none")
        drop_partition(self.table, "step", self.step)
        self.step += 1

    def model(self) -> DataFrame:
        return self.table.files().mapInArrow(_unpack, "role STRING, id LONG, vec ARRAY<DOUBLE>")

    def errors(self) -> DataFrame:
        return cell_errors(self.layout, self.table.files(), _unpack)

    def drop(self) -> None:
        """Take the table's name out of the catalog; its files stay."""
        drop_table(self.table)
