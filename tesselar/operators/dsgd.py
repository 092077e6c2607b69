"""Stratified distributed SGD on stored blocks.

Ratings are stored once, in folders by turn and buckets by row strip, with the levels of their samples. Factors are
stored in buckets too: a user vector in the bucket of its row strip, an item vector in that of the row strip it meets
in the next turn. A turn reads both bucket by bucket, updates every sub-block in one task and writes the factors to
the buckets of the turn after: nothing is shuffled, and only item vectors change their bucket.

The sub-blocks of one turn share no user and no item. Inside one the samples are taken in a given order. Samples that
share neither user nor item do not affect each other, so each sample gets a level, one more than the last level of its
user and of its item; the samples of a level are updated together with the same result as one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesselar.operators.cuts import Cuts
from tesselar.operators.skew import ROWS_PER_BLOCK, rows_of_part
from tesselar.workspace import BucketedTable, bucket_keys, drop_table, new_path, write_buckets

IN_ORDER = ("i", "j", "r")
LAYOUT_SCHEMA = "s INT, bk INT, rs INT, cs INT, lvl LONG, i LONG, j LONG, r DOUBLE"
FACTOR_SCHEMA = "role STRING, id LONG, vec ARRAY<DOUBLE>, key INT, bk INT"
#: Rows of this role carry the error of a block: its number and (squared error, samples).
ERROR = "E"
#: Copies of vectors that a batch holds at most, unless one vector has more.
COPIES = 1 << 14
#: A frontier of fewer samples is not worth an array operation.
NARROW = 48


def sample_levels(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """The level of every sample of a block, given in order: 1 + the larger level of the samples before it with its
    user or item.

    The samples without an unlevelled one before them are peeled off together, as long as there are many; the rest is
    walked through in order.
    """
    n = len(users)
    waits, after = np.zeros(n, np.int8), []
    for ids in (users, items):
        order = np.argsort(ids, kind="stable")
        same = ids[order[1:]] == ids[order[:-1]]
        next_one = np.full(n, -1)
        next_one[order[:-1][same]] = order[1:][same]
        waits[order[1:][same]] += 1
        after.append(next_one)
    levels = np.zeros(n, np.int64)
    frontier, level = np.flatnonzero(waits == 0), 0
    while len(frontier) >= NARROW:
        level += 1
        levels[frontier] = level
        freed = np.concatenate([next_one[frontier] for next_one in after])
        freed = freed[freed >= 0]
        # At most two in the frontier wait for one sample: once as its user, once as its item.
        np.subtract.at(waits, freed, 1)
        frontier = np.unique(freed[waits[freed] == 0])
    rest = np.flatnonzero(levels == 0)
    if len(rest):
        _walk(users, items, levels, rest)
    return levels


def _walk(users: np.ndarray, items: np.ndarray, levels: np.ndarray, rest: np.ndarray) -> None:
    last: tuple[dict[int, int], dict[int, int]] = ({}, {})
    done = np.flatnonzero(levels)
    for ids, found in zip((users, items), last, strict=True):
        # The last levelled sample of an id has its largest level.
        unique, place = np.unique(ids[done][::-1], return_index=True)
        found.update(zip(unique.tolist(), levels[done][::-1][place].tolist(), strict=True))
    user_level, item_level = last
    walked = []
    for user, item in zip(users[rest].tolist(), items[rest].tolist(), strict=True):
        level = 1 + max(user_level.get(user, 0), item_level.get(item, 0))
        user_level[user] = item_level[item] = level
        walked.append(level)
    levels[rest] = walked


def _sub_blocks(batches: Iterator[pa.RecordBatch], row: str = "rs", col: str = "cs") -> Iterator[pa.Table]:
    """The rows of each pair of ``row`` and ``col`` from a partition sorted by them."""
    parts: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        rows, cols = batch.column(row).to_numpy(), batch.column(col).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(rows) | np.diff(cols)) + 1).tolist(), len(rows)]
        for start, end in pairwise(edges):
            if start == end:
                continue
            if parts and (rows[start], cols[start]) != last:
                yield pa.Table.from_batches(parts)
                parts = []
            last = (rows[start], cols[start])
            parts.append(batch.slice(start, end - start))
    if parts:
        yield pa.Table.from_batches(parts)


def _add_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in LAYOUT_SCHEMA.split(", ")]
    for block in _sub_blocks(batches):
        levels = sample_levels(block.column("i").to_numpy(), block.column("j").to_numpy())
        yield from block.append_column("lvl", pa.array(levels)).select(names).to_batches()


@dataclass(frozen=True)
class Layout:
    """Stored samples: ``s`` (turn), ``bk`` (bucket key of the row strip), strips, level, ``i``, ``j``, ``r``."""

    table: BucketedTable
    cuts: Cuts
    keys: tuple[int, ...]

    @property
    def buckets(self) -> int:
        return len(self.keys)

    @property
    def turns(self) -> int:
        return self.cuts.turns

    @property
    def samples(self) -> DataFrame:
        return self.table.read()

    def turn(self, turn: int) -> DataFrame:
        return self.samples.where(F.col("s") == turn)

    def drop(self) -> None:
        """Take the table's name out of the catalog; its files stay."""
        drop_table(self.table)


def _placed(cuts: Cuts, keys: tuple[int, ...], tasks: int):
    cells = None if cuts.cells is None else np.array(cuts.cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = cuts.strip(cuts.rows, batch.column("i").to_numpy())
            col = cuts.strip(cuts.cols, batch.column("j").to_numpy())
            turn = cuts.turn(row, col)
            if (turn < 0).any():
                raise ValueError("a rating in a sub-block that the cuts take for empty")
            number = row * len(cuts.cols) + col
            # Sub-blocks with ratings are dealt to the tasks in turn.
            task = (number if cells is None else np.searchsorted(cells, number)) % tasks
            added = {"s": turn, "bk": np.array(keys)[row], "rs": row, "cs": col, "task": task}
            columns = [pa.array(values.astype(np.int32)) for values in added.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *added])

    return run


def checked_ratings(ratings: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``i``, ``j``, ``r`` and the columns of the order. A null id or rating raises."""
    wanted = [*IN_ORDER, *[name for name in order if name not in IN_ORDER]]
    complete = F.col("i").isNotNull() & F.col("j").isNotNull() & F.col("r").isNotNull()
    checked = F.when(complete, F.col("i")).otherwise(F.raise_error(F.lit("a rating without user, item or value")).cast("long"))
    return ratings.select(*wanted).withColumn("i", checked)


def block_layout(
    ratings: DataFrame,
    cuts: Cuts,
    order: tuple[str, ...] = IN_ORDER,
    rows_per_block: int = ROWS_PER_BLOCK,
    rows: int | None = None,
) -> Layout:
    """Store the ratings by sub-block; one shuffle of the ratings, whose tasks follow their number ``rows``.

    ``order`` names the columns that order the samples of a block, such as a line number. A null id or rating raises.
    Without ``rows`` the ratings are counted first. With cuts in ``any_order`` the samples have no order and no levels.
    """
    spark = ratings.sparkSession
    whole = Cuts.whole_blocks(cuts.grid)
    if tuple(order) != IN_ORDER and (cuts.rows, cuts.cols) != (whole.rows, whole.cols):
        raise ValueError("cut blocks keep the result only for samples in (i, j, r) order")
    keys = bucket_keys(spark, len(cuts.rows))
    complete_rows = checked_ratings(ratings, order)
    schema = T.StructType([*complete_rows.schema.fields, *[T.StructField(name, T.IntegerType()) for name in ("s", "bk", "rs", "cs", "task")]])
    # Sub-blocks in as many tasks as the rows need, but no more than there are sub-blocks.
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = ratings.count() if rows is None else rows
    cells = len(cuts.rows) * len(cuts.cols) if cuts.cells is None else len(cuts.cells)
    tasks = min(max(cells, 1), max(at_least, -(-rows // rows_of_part(rows, rows_per_block, ROWS_PER_BLOCK))))
    placed = complete_rows.mapInArrow(_placed(cuts, keys, tasks), schema)
    by_block = placed.repartitionById(tasks, F.col("task"))
    if cuts.any_order:
        levelled = by_block.withColumn("lvl", F.lit(0).cast("long")).select(*[field.split()[0] for field in LAYOUT_SCHEMA.split(", ")])
    else:
        levelled = by_block.sortWithinPartitions("rs", "cs", *order).mapInArrow(_add_levels, LAYOUT_SCHEMA)
    table = write_buckets(levelled, new_path(spark, "layout"), len(keys), "bk", partition_by="s", sort_by="lvl")
    return Layout(table, cuts, keys)


def _stored_vectors(ids: np.ndarray, rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(ids) + 1, dtype=np.int32) * (rows.shape[1] if len(ids) else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel(), pa.float64()))


class _Side:
    """The factor rows of one role in a bucket, looked up by id."""

    def __init__(self, role: str, stored: pa.Table):
        self.role = role
        mine = stored.filter(pc.equal(stored.column("role"), role)).combine_chunks()
        ids = mine.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors = mine.column("vec").combine_chunks()
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        self.ids = ids[order]
        self.rows = values.reshape(len(ids), -1 if len(ids) else 0)[order]

    def index(self, ids: np.ndarray) -> np.ndarray:
        found = np.searchsorted(self.ids, ids)
        known = found < len(self.ids)
        known[known] = self.ids[found[known]] == ids[known]
        if not known.all():
            raise ValueError(f"no {self.role} vector for id {ids[~known][0]}")
        return found


def _learn(w: _Side, h: _Side, samples: pa.Table, eta: float, sequential: bool) -> None:
    levels = samples.column("lvl").to_numpy()
    # Stored by level; a reader that mixes files may not keep that.
    order = None if (levels[1:] >= levels[:-1]).all() else np.argsort(levels, kind="stable")
    columns = [samples.column(name).to_numpy() for name in ("i", "j", "r", "lvl")]
    ids, other, ratings, levels = columns if order is None else [column[order] for column in columns]
    users, items = w.index(ids), h.index(other)
    cuts = [0, *(np.flatnonzero(np.diff(levels)) + 1).tolist(), len(levels)]
    for start, end in pairwise(cuts):
        a, b = users[start:end], items[start:end]
        w_old, h_old = w.rows[a], h.rows[b]
        step = ratings[start:end] - np.einsum("nk,nk->n", w_old, h_old)
        step = (2.0 * eta * step)[:, None]
        w_new = w_old + step * h_old
        w.rows[a] = w_new
        h.rows[b] = h_old + step * (w_new if sequential else w_old)


def _error(w: _Side, h: _Side, samples: pa.Table) -> tuple[float, int]:
    users, items = w.index(samples.column("i").to_numpy()), h.index(samples.column("j").to_numpy())
    ratings, total = samples.column("r").to_numpy(), 0.0
    for start in range(0, len(users), 1 << 16):
        part = slice(start, start + (1 << 16))
        difference = ratings[part] - np.einsum("nk,nk->n", w.rows[users[part]], h.rows[items[part]])
        total += float(difference @ difference)
    return total, len(users)


def _turn_kernel(layout: Layout, next_turn: int, eta: float | None, sequential: bool, measure: str | None, carry: bool):
    """Learn the samples of a bucket, measure their error, or both, and send every factor row to its next bucket."""
    cuts, keys = layout.cuts, np.array(layout.keys)
    following = cuts.met_by(next_turn)

    def measured(w: _Side, h: _Side, samples: pa.Table) -> pa.Table:
        row, col = samples.column("rs")[0].as_py(), samples.column("cs")[0].as_py()
        block = int(cuts.row_blocks[row]) * cuts.grid.n + int(cuts.col_blocks[col])
        return _factor_table(ERROR, np.array([block]), np.array([_error(w, h, samples)], float), np.array([row]), keys)

    def run(samples: pa.Table, stored: pa.Table) -> pa.Table:
        w, h = _Side("W", stored), _Side("H", stored)
        parts = []
        if samples.num_rows:
            if measure == "before":
                parts.append(measured(w, h, samples))
            if eta is not None:
                _learn(w, h, samples, eta, sequential)
            if measure == "after":
                parts.append(measured(w, h, samples))
        if carry:
            # Errors of earlier turns.
            parts.append(stored.filter(pc.equal(stored.column("role"), ERROR)).select(["role", "id", "vec", "key", "bk"]))
        parts.append(_factor_table("W", w.ids, w.rows, cuts.strip(cuts.rows, w.ids), keys))
        parts.append(_factor_table("H", h.ids, h.rows, following[cuts.strip(cuts.cols, h.ids)], keys))
        return pa.concat_tables(parts)

    return run


def _factor_table(role: str, ids: np.ndarray, rows: np.ndarray, strips: np.ndarray, keys: np.ndarray) -> pa.Table:
    columns = {
        "role": pa.array([role] * len(ids), pa.string()),
        "id": pa.array(ids.astype(np.int64)),
        "vec": _stored_vectors(ids, rows),
        "key": pa.array(strips.astype(np.int32)),
        "bk": pa.array(keys[strips].astype(np.int32)),
    }
    return pa.table(columns)


def place_factors(factors: DataFrame, layout: Layout, turn: int = 0) -> DataFrame:
    """Factor rows with the row strip (``key``) and the bucket where they are needed in ``turn``. No shuffle."""
    cuts, keys = layout.cuts, np.array(layout.keys)
    met = cuts.met_by(turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            user = pc.equal(batch.column("role"), "W").to_numpy(zero_copy_only=False)
            strips = np.where(user, cuts.strip(cuts.rows, ids), met[cuts.strip(cuts.cols, ids)])
            added = [pa.array(strips.astype(np.int32)), pa.array(keys[strips].astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], ["role", "id", "vec", "key", "bk"])

    return factors.select("role", F.col("id").cast("long").alias("id"), "vec").mapInArrow(run, FACTOR_SCHEMA)


class FactorStore:
    """Factors in the buckets of a layout: two tables, written in turn, so a lost executor repeats one turn at most."""

    def __init__(self, layout: Layout, factors: DataFrame, turn: int = 0):
        self.layout, self.spark = layout, factors.sparkSession
        self.paths = [new_path(self.spark, "factors") for _ in range(2)]
        self.tables: list[BucketedTable | None] = [None, None]
        self.current = 1
        self.write(place_factors(factors, layout, turn))

    def write(self, placed: DataFrame) -> None:
        at = 1 - self.current
        old, self.tables[at] = self.tables[at], None
        if old is not None:
            drop_table(old)
        self.tables[at] = write_buckets(placed, self.paths[at], self.layout.buckets, "bk", mode="overwrite")
        self.current = at

    def read(self) -> DataFrame:
        return self.tables[self.current].read()

    def errors(self) -> DataFrame:
        return cell_errors(self.layout, self.model())

    def drop(self) -> None:
        """Take the names of both tables out of the catalog; the files stay."""
        for table in self.tables:
            if table is not None:
                drop_table(table)

    def files(self) -> DataFrame:
        """The current rows from their files, also once the tables are dropped."""
        return self.tables[self.current].files()

    def model(self) -> DataFrame:
        return self.files().where(F.col("role") != ERROR).select("role", "id", "vec")


def _in_buckets(layout: Layout, turn: int, stored: DataFrame, kernel, columns: list[str]) -> DataFrame:
    samples = layout.turn(turn).select("bk", *columns)
    return samples.groupBy("bk").cogroup(stored.groupBy("bk")).applyInArrow(kernel, FACTOR_SCHEMA)


def dsgd_update(
    layout: Layout,
    stored: DataFrame,
    turn: int,
    eta: float,
    update: str = "simultaneous",
    next_turn: int | None = None,
    measure: str | None = None,
) -> DataFrame:
    """One turn: the factors after learning the sub-blocks of ``turn``, placed for ``next_turn`` (default: the one after).

    ``stored`` is what ``place_factors``, a ``FactorStore`` or the turn before returned. With ``update="sequential"``
    an item's step uses the user row that was just updated. Factors of blocks without samples pass through.
    ``measure`` adds rows of role ``E`` with the error of the sub-blocks ``before`` the learning, to those that are there,
    or ``after`` it, in their place.
    """
    if update not in ("simultaneous", "sequential"):
        raise ValueError(f"unknown update rule {update!r}")
    following = (turn + 1) % layout.cuts.turns if next_turn is None else next_turn
    kernel = _turn_kernel(layout, following, eta, update == "sequential", measure, measure == "before")
    return _in_buckets(layout, turn, stored, kernel, ["rs", "cs", "lvl", "i", "j", "r"])


def turn_error(layout: Layout, stored: DataFrame, turn: int, next_turn: int, carry: bool = True) -> DataFrame:
    """The factors, unchanged but placed for ``next_turn``, and a row of role ``E`` for every sub-block of ``turn``.

    Rows of other sub-blocks stay if ``carry``.
    """
    kernel = _turn_kernel(layout, next_turn, None, False, "before", carry)
    return _in_buckets(layout, turn, stored, kernel, ["rs", "cs", "i", "j", "r"])


def _to_cells(cuts: Cuts):
    """A copy of every factor row for each sub-block with samples that its strip has."""
    n_rows, n_cols = len(cuts.rows), len(cuts.cols)
    cells = np.arange(n_rows * n_cols) if cuts.cells is None else np.array(cuts.cells, np.int64)
    row, col = cells // n_cols, cells % n_cols
    # The sub-blocks of every row strip, then those of every column strip.
    listed = np.concatenate([cells[np.argsort(strips, kind="stable")] for strips in (row, col)])
    copies = np.concatenate([np.bincount(row, minlength=n_rows), np.bincount(col, minlength=n_cols)])
    first = np.cumsum(copies) - copies
    rows_at_once = max(1, COPIES // max(1, int(copies.max(initial=0))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(start, rows_at_once)
                ids = batch.column("id").to_numpy()
                user = pc.equal(batch.column("role"), "W").to_numpy(zero_copy_only=False)
                strip = np.where(user, cuts.strip(cuts.rows, ids), n_rows + cuts.strip(cuts.cols, ids))
                count = copies[strip]
                end = np.cumsum(count)
                place = np.arange(end[-1]) + np.repeat(first[strip] - (end - count), count)
                copied = batch.take(pa.array(np.repeat(np.arange(len(ids)), count)))
                yield pa.RecordBatch.from_arrays([pa.array(listed[place]), *copied.columns], ["cell", "role", "id", "vec"])

    return run


def cell_errors(layout: Layout, factors: DataFrame, unpacked=None) -> DataFrame:
    """``squared_error`` and ``n`` of every sub-block with samples, in one job whatever the number of turns.

    Every sub-block gets the vectors of its two strips and its samples by one shuffle: a vector is copied once for each
    sub-block of its strip, which are never more than the turns that would pass it on. A task holds one sub-block at a time.
    ``unpacked`` is what makes ``role``, ``id``, ``vec`` of the batches of ``factors``, in the same Python worker.
    """
    cuts, n_cols, to_cells = layout.cuts, len(layout.cuts.cols), _to_cells(layout.cuts)
    if unpacked is None:
        vectors, copy = factors.select("role", F.col("id").cast("long").alias("id"), "vec"), to_cells
    else:
        vectors, copy = factors, lambda batches: to_cells(unpacked(batches))
    copied = vectors.mapInArrow(copy, "cell LONG, role STRING, id LONG, vec ARRAY<DOUBLE>")
    samples = layout.samples.select((F.col("rs").cast("long") * n_cols + F.col("cs")).alias("cell"), "i", "j", "r")

    def run(samples: pa.Table, stored: pa.Table) -> pa.Table:
        errors = [_error(_Side("W", stored), _Side("H", stored), samples)] if samples.num_rows else []
        return pa.table({"squared_error": pa.array([e for e, _ in errors], pa.float64()), "n": pa.array([n for _, n in errors], pa.int64())})

    return samples.groupBy("cell").cogroup(copied.groupBy("cell")).applyInArrow(run, "squared_error DOUBLE, n LONG")
