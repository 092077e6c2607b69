"""Best-fit packing with swap-based local search.

Documents become token pieces of at most one sequence. What matters of a piece is its length, so all pieces are packed at
once, as counts by length: best fit first, then pieces move between underfull bins, or are exchanged one for one or two
for one, whenever that raises the sum of squared fills, until bins empty and no exchange helps. Equal bins are one kind
with a number of copies. The pieces of a length, numbered through, then take the places that the plan has for them.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesselar.llm.encode import ID_BYTES, encoder
from tesselar.llm.word_pointers import slices
from tesselar.workspace import materialize

CAPACITY = 2048
END_ID = 0
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than the capacity."""
    first = total % capacity or min(total, capacity)
    return [(0, first), *((start, capacity) for start in range(first, total, capacity))]


def _pieces(path: str, end_id: int, capacity: int, added_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(path, added_tokens), np.array([end_id], "<u4").tobytes()
        task, given = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            columns: list[list[int]] = [[] for _ in range(7)]
            for part in slices(iter([batch])):
                encoded = words.ids(part.column("text"))
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                    ids += end
                    for piece, (start, length) in enumerate(cut(len(ids) // ID_BYTES, capacity)):
                        crc = zlib.crc32(ids[start * ID_BYTES : (start + length) * ID_BYTES])
                        for column, value in zip(columns, (doc_id, piece, start, length, crc, task, given[length]), strict=True):
                            column.append(value)
                        given[length] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


@dataclass
class Bins:
    """``copies`` bins of one content: the pieces of each length in it."""

    content: Counter[int]
    copies: int

    @property
    def fill(self) -> int:
        return sum(length * n for length, n in self.content.items())


def best_fit(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Longest first, each into the fullest bin that has room. ``counts`` are pieces by length.

    Equal bins are filled together: a step uses up either the pieces of a length or the bins of a kind, so there are
    about as many kinds as lengths, however many pieces there are.
    """
    by_room: dict[int, list[Bins]] = {}
    rooms: list[int] = []  # in ascending order

    def keep(bins: Bins, room: int) -> None:
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append(bins)

    full: list[Bins] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                # New bins, with as many pieces of this length each as fit.
                each = min(left, capacity // length)
                made, left = left // each, left % each
                keep_room = capacity - each * length
                new = Bins(Counter({length: each}), made)
                full.append(new) if keep_room == 0 else keep(new, keep_room)
                continue
            room = rooms[at]
            bins = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            each = min(left, room // length)
            used = min(bins.copies, left // each)
            if used < bins.copies:
                keep(Bins(bins.content.copy(), bins.copies - used), room)
            bins = Bins(bins.content + Counter({length: each}), used)
            left -= used * each
            rest = room - each * length
            full.append(bins) if rest == 0 else keep(bins, rest)
    return [*full, *(bins for room in rooms for bins in by_room[room])]


def fewest_bins(counts: dict[int, int], capacity: int) -> int:
    """A number of bins that no packing can do with less.

    For every small size: pieces too long to share a bin with one of it, pieces longer than half a bin, and the bins
    that the pieces between need beyond the space the latter leave.
    """
    lengths = sorted(counts)
    best, half = 0, capacity // 2
    long_ = sum(n for length, n in counts.items() if length > half)
    for small in [0, *(length for length in lengths if length <= half)]:
        space = sum((capacity - length) * n for length, n in counts.items() if half < length <= capacity - small)
        rest = sum(length * n for length, n in counts.items() if small <= length <= half)
        best = max(best, long_ + max(0, -(-(rest - space) // capacity)))
    return best


class _Search:
    """Local search over kinds of bins: pieces move from the emptiest bins to fuller ones.

    A step that takes d tokens from a bin A to a bin B at least as full raises the sum of squared fills by
    2 d (fill B - fill A + d) > 0. It is taken for as many equal pairs of bins as there are. The sum is a bounded
    integer, so the search ends: when the bins are as few as can be, or when no step from any of the bins helps.
    """

    def __init__(self, bins: list[Bins], capacity: int):
        self.capacity = capacity
        self.kinds: dict[tuple[tuple[int, int], ...], Bins] = {}
        #: Kinds by fill, the emptiest first; and the clock of a kind's arrival.
        self.by_fill: dict[int, set[tuple[tuple[int, int], ...]]] = {}
        self.clock, self.arrived, self.tried = 0, {}, {}
        for one in bins:
            self._put(one.content, one.copies)

    def _put(self, content: Counter[int], copies: int) -> None:
        key = tuple(sorted((length, n) for length, n in content.items() if n))
        if not key:
            return
        if key in self.kinds:
            self.kinds[key].copies += copies
        else:
            self.kinds[key] = Bins(Counter(dict(key)), copies)
            self.by_fill.setdefault(self.kinds[key].fill, set()).add(key)
            self.tried.pop(key, None)
        self.clock += 1
        self.arrived[key] = self.clock

    def _take(self, key: tuple[tuple[int, int], ...], copies: int) -> None:
        bins = self.kinds[key]
        bins.copies -= copies
        if not bins.copies:
            fill = bins.fill
            self.by_fill[fill].discard(key)
            if not self.by_fill[fill]:
                del self.by_fill[fill]
            del self.kinds[key], self.arrived[key]
            self.tried.pop(key, None)

    def step(self, key: tuple[tuple[int, int], ...]) -> bool:
        """The move or exchange from a bin of this kind that raises the sum of squared fills most, if any does."""
        source = self.kinds[key]
        ones = sorted(source.content)
        outs: dict[int, tuple[int, ...]] = {}
        for at, a in enumerate(ones):
            outs.setdefault(a, (a,))
            for b in ones[at:]:
                if a != b or source.content[a] > 1:
                    outs.setdefault(a + b, (a, b))
        sums = sorted(outs)
        since, fill = self.tried.get(key, -1), source.fill
        best: tuple[int, tuple, tuple[int, ...], int] | None = None
        # Of equal steps the one to the fullest bin.
        for other_fill in sorted((f for f in self.by_fill if fill <= f < self.capacity), reverse=True):
            room = self.capacity - other_fill
            for other in self.by_fill[other_fill]:
                if self.arrived[other] <= since or (other == key and source.copies < 2):
                    continue
                # One piece moves, or one or two come for one that goes back: the largest that fit.
                for back in (0, *self.kinds[other].content):
                    at = bisect_right(sums, room + back) - 1
                    if back == 0:
                        while at >= 0 and len(outs[sums[at]]) > 1:
                            at -= 1
                    if at < 0 or sums[at] <= back:
                        continue
                    gain = sums[at] - back
                    rise = gain * (other_fill - fill + gain)
                    if best is None or rise > best[0]:
                        best = rise, other, outs[sums[at]], back
        if best is None:
            self.tried[key] = self.clock
            return False
        _, other, out, back = best
        content, target = source.content.copy(), self.kinds[other].content.copy()
        copies = source.copies // 2 if other == key else min(source.copies, self.kinds[other].copies)
        self._take(key, copies)
        self._take(other, copies)
        for length in out:
            content[length] -= 1
            target[length] += 1
        if back:
            content[back] += 1
            target[back] -= 1
        self._put(content, copies)
        self._put(target, copies)
        return True

    def run(self, fewest: int) -> list[Bins]:
        while sum(bins.copies for bins in self.kinds.values()) > fewest:
            # The emptiest kind that was not tried since the last change.
            open_ = (key for fill in sorted(self.by_fill) if fill < self.capacity for key in self.by_fill[fill])
            source = next((key for key in open_ if self.tried.get(key, -1) < self.clock), None)
            if source is None:
                break
            self.step(source)
        return list(self.kinds.values())


def piece_counts(bins: list[Bins]) -> Counter[int]:
    """The pieces of each length in all bins."""
    counts: Counter[int] = Counter()
    for one in bins:
        counts.update({length: n * one.copies for length, n in one.content.items()})
    return counts


def improve(bins: list[Bins], capacity: int) -> list[Bins]:
    """Local search: empty the emptiest bins while there are more bins than the pieces need."""
    return _Search(bins, capacity).run(fewest_bins(piece_counts(bins), capacity))


def plan(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Kinds of bins that hold all pieces: best fit, then local search."""
    return improve(best_fit(counts, capacity), capacity)


def _slots(kinds: list[Bins], capacity: int) -> dict[int, np.ndarray]:
    """For each length, runs of its pieces in the bins: (first piece, first bin, pieces of a bin, offset in the bin)."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    given: Counter[int] = Counter()
    first_bin = 0
    for bins in kinds:
        offset = 0
        for length, each in sorted(bins.content.items(), reverse=True):
            runs.setdefault(length, []).append((given[length], first_bin, each, offset))
            given[length] += each * bins.copies
            offset += length * each
        first_bin += bins.copies
    return {length: np.array(rows, np.int64) for length, rows in runs.items()}


def _place(slots):
    """Give every piece, by its length and its number among those of this length, its bin and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = [0, *(np.flatnonzero(np.diff(length[order])) + 1).tolist(), len(order)]
            for start, end in pairwise(edges):
                if start == end:
                    continue
                mine = order[start:end]
                size = int(length[mine[0]])
                first, first_bin, each, at = slots.value[size].T
                run_of = np.searchsorted(first, number[mine], "right") - 1
                inside, turn = np.divmod(number[mine] - first[run_of], each[run_of])
                sequence[mine] = first_bin[run_of] + inside
                offset[mine] = at[run_of] + turn * size
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return run


def pack(documents: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, added_tokens: bool = False) -> DataFrame:
    """One row per token piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A null or empty text is its end id alone. Repeated rows and rows with a null id are packed each on its own.
    Other columns are ignored; an empty table gives no rows. ``added_tokens`` as in ``WordEncoder``. Of all pieces the
    driver gets one count per length, at most ``capacity`` of them.
    """
    spark = documents.sparkSession
    pieces = documents.select("doc_id", "text").mapInArrow(_pieces(tokenizer, end_id, capacity, added_tokens), PIECE + ", task int, place long")
    pieces = materialize(pieces, "pieces")
    # Pieces of a length are numbered through: by task, and within a task as they came.
    held = materialize(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    counts = {row["length"]: row["n"] for row in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(plan(counts, capacity), capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, ["length", "task"]).withColumn("number", F.col("base") + F.col("place"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(_place(slots), PIECE + ", sequence_id long, offset long")


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(documents, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)
