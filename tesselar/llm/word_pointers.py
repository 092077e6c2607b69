"""Pointers to the words of a text column, in NumPy over the buffers of Arrow: no word becomes a Python object."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tesselar.llm.grams import BASE, mix

#: Bytes of text that are looked at together; one text above them is a slice of its own.
SLICE_BYTES = 8 << 20
#: Only A-Z are lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Which byte values lie in one of the ranges (both ends included)."""
    chosen = np.zeros(256, bool)
    for low, high in ranges:
        chosen[low : high + 1] = True
    return chosen


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, cut so that the texts of a slice hold about ``limit`` bytes at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        number = (np.cumsum(sizes) - sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(start, end - start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each row begins and the last one ends; a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


class Pointers:
    """Pieces of text as ``start`` and ``length`` in ``data``, which ends with eight zeros."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.data, self.start, self.length = data, start, length

    def __len__(self) -> int:
        return len(self.start)

    def at(self, which: np.ndarray) -> "Pointers":
        """The words ``which``."""
        return Pointers(self.data, self.start[which], self.length[which])

    def eight(self, which: np.ndarray, depth: int) -> np.ndarray:
        """Bytes 8 * depth to 8 * depth + 7 of the words ``which`` as a number in byte order, zeros behind the end."""
        left = self.length[which] - 8 * depth
        at = np.where(left > 0, self.start[which] + 8 * depth, len(self.data) - 8)
        # The eight bytes from every place on, as numbers that overlap.
        value = np.ndarray((len(self.data) - 7,), ">u8", np.ascontiguousarray(self.data), strides=(1,))[at].astype(np.uint64)
        cut = (8 * (8 - np.clip(left, 1, 8))).astype(np.uint64)
        return value >> cut << cut

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64 bits of every piece, from its length and all its bytes."""
        value = mix(self.length.astype(np.uint64) + np.uint64(seed) * np.uint64(BASE))
        live, depth = np.arange(len(self)), 0
        while len(live):
            value[live] = mix(value[live] * np.uint64(BASE) + self.eight(live, depth))
            depth += 1
            live = live[self.length[live] > 8 * depth]
        return value

    def texts(self, which: np.ndarray) -> pa.Array:
        """The words ``which`` as strings."""
        whole = self.data.tobytes()
        starts, ends = self.start[which].tolist(), (self.start[which] + self.length[which]).tolist()
        return pa.array([whole[a:b] for a, b in zip(starts, ends, strict=True)], pa.binary()).cast(pa.string())


class Words(Pointers):
    """Every run of ``word`` bytes of a text column with its ``row``; A-Z are lower-cased in ``data``."""

    def __init__(self, texts: pa.Array, word: np.ndarray):
        raw, offsets = text_bytes(texts)
        inside = word[raw]
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        begins, ends = offsets[:-1], offsets[1:] - 1
        before[begins[begins < len(raw)]] = False
        after[ends[ends >= 0]] = False
        start = np.flatnonzero(inside & ~before)
        length = np.flatnonzero(inside & ~after) + 1 - start
        super().__init__(np.concatenate([LOWER[raw], np.zeros(8, np.uint8)]), start, length)
        self.raw = raw
        self.row = np.searchsorted(offsets, start, "right") - 1
