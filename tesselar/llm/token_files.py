"""Token ids in files of directly addressable codes.

An id is split into chunks of 8 bits, lowest first, and only as many as it needs. Level k holds the k-th chunks of all
ids that have one, and a bitmap that says which of them go on to level k + 1. A rank directory counts the ones before
every 512 bits, so the chunks of any id are found by one rank per level, without decoding what lies before it.

A segment holds whole consecutive documents. Segments are rows of a Parquet folder written by Spark, so they can be
in any store Spark writes to and a lost task leaves no half segment; the payload itself is the byte format below.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselar.llm.encode import ID_BYTES, encoder
from tesselar.llm.word_pointers import slices
from tesselar.workspace import new_path

#: Fixed values of the format: mark and version, bits of a chunk, bits between two entries of a rank directory.
MAGIC = b"DAC1"
CHUNK = 8
RANK_BITS = 512
#: A segment is closed by the document that brings it to so many tokens.
SEGMENT_TOKENS = 1 << 20
END_ID = 2
#: ``first``: tokens of the part before the segment.
SEGMENT = "part long, segment long, first long, n_docs long, n_tokens long, payload binary"


def write_segment(documents: list[tuple[int | None, np.ndarray]]) -> bytes:
    """Header, document table (id, null mark, first token), then per level: chunks, bitmap, rank directory."""
    ids = np.concatenate([one for _, one in documents]) if documents else np.empty(0, np.uint32)
    starts = np.cumsum([0, *[len(one) for _, one in documents]]).astype("<u8")
    names = np.array([0 if name is None else name for name, _ in documents], "<i8")
    nulls = np.array([name is None for name, _ in documents], np.uint8)
    levels = []
    rest = ids.astype(np.uint32)
    while len(rest):
        more = rest >> np.uint32(CHUNK) > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        ones = np.unpackbits(bits).reshape(-1, RANK_BITS).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        levels.append((rest.astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()))
        rest = rest[more] >> np.uint32(CHUNK)
    parts = [MAGIC, struct.pack("<QI", len(documents), len(levels)), names.tobytes(), nulls.tobytes(), starts.tobytes()]
    for level in levels:
        parts += [struct.pack("<QQQ", *map(len, level)), *level]
    return b"".join(parts)


class Segment:
    """Random access to a segment's documents and tokens."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token segment")
        n, n_levels = struct.unpack_from("<QI", payload, 4)
        at = 4 + struct.calcsize("<QI")
        self.names = np.frombuffer(payload, "<i8", n, at)
        at += 8 * n
        self.nulls = np.frombuffer(payload, np.uint8, n, at)
        at += n
        self.starts = np.frombuffer(payload, "<u8", n + 1, at)
        at += 8 * (n + 1)
        self.levels = []
        for _ in range(n_levels):
            chunks, bits, ranks = struct.unpack_from("<QQQ", payload, at)
            at += struct.calcsize("<QQQ")
            self.levels.append(
                (
                    np.frombuffer(payload, np.uint8, chunks, at),
                    np.frombuffer(payload, np.uint8, bits, at + chunks),
                    np.frombuffer(payload, "<u4", ranks // 4, at + chunks + bits),
                )
            )
            at += chunks + bits + ranks

    def token(self, at: int) -> int:
        """Token number ``at`` of the segment, by one rank per level."""
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[at]) << shift
            if not bits[at >> 3] >> (at & 7) & 1:
                break
            block = at // RANK_BITS
            first = block * RANK_BITS // 8
            before = np.unpackbits(bits[first : (at >> 3) + 1], bitorder="little")[: at - block * RANK_BITS]
            at = int(ranks[block]) + int(before.sum())
            shift += CHUNK
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Tokens ``start`` to ``end``: a range of a level continues as one range of the next."""
        values = np.zeros(end - start, np.uint32)
        place, shift = np.arange(end - start), 0
        for chunks, bits, ranks in self.levels:
            values[place] |= chunks[start:end].astype(np.uint32) << np.uint32(shift)
            flags = np.unpackbits(bits[start >> 3 : (end + 7) >> 3], bitorder="little")[start & 7 :][: end - start].astype(bool)
            block = start // RANK_BITS
            before = np.unpackbits(bits[block * RANK_BITS // 8 : (start >> 3) + 1], bitorder="little")
            place = place[flags]
            if not len(place):
                break
            start = int(ranks[block]) + int(before[: start - block * RANK_BITS].sum())
            end = start + len(place)
            shift += CHUNK
        return values


def _segments(path: str, end_id: int, added_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, added_tokens)
        end = np.array([end_id], np.uint32)
        held: list[tuple[int | None, np.ndarray]] = []
        tokens, segment, part, before = 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            arrays = [
                pa.array([part], pa.int64()),
                pa.array([segment], pa.int64()),
                pa.array([before], pa.int64()),
                pa.array([len(held)], pa.int64()),
                pa.array([tokens], pa.int64()),
                pa.array([write_segment(held)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["part", "segment", "first", "n_docs", "n_tokens", "payload"])

        for batch in batches:
            for piece in slices(iter([batch])):
                part = piece.column("part")[0].as_py()
                encoded = words.ids(piece.column("text"))
                for name, ids in zip(piece.column("doc_id").to_pylist(), encoded, strict=True):
                    held.append((name, np.concatenate([np.frombuffer(ids, "<u4"), end])))
                    tokens += len(ids) // ID_BYTES + 1
                    if tokens >= SEGMENT_TOKENS:
                        yield close()
                        held, tokens, segment, before = [], 0, segment + 1, before + tokens
        if held:
            yield close()

    return run


def write_tokens(documents: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, added_tokens: bool = False) -> None:
    """Write the ids of all texts in ascending ``doc_id`` order as segments below ``path``.

    A null or empty text is its end id alone. Rows with a null ``doc_id`` come first; repeated rows are written each,
    in any order among themselves. Other columns are ignored. An empty table gives an empty folder.
    ``added_tokens`` as in ``WordEncoder``.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))
    dealt = dealt.withColumn("part", F.spark_partition_id().cast("long"))
    dealt.mapInArrow(_segments(tokenizer, end_id, added_tokens), SEGMENT).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            segment = Segment(batch.column("payload")[row].as_py())
            first = batch.column("first")[row].as_py()
            starts = segment.starts.astype(np.int64)
            crcs = [zlib.crc32(segment.tokens(a, b).astype("<u4").tobytes()) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            names = pa.array(segment.names, pa.int64(), mask=segment.nulls.astype(bool))
            columns = [names, pa.array(first + starts[:-1]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the segments below ``path``: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    # One number per part: as many as the writer had partitions.
    before, bases = 0, []
    for row in segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        bases.append((row["part"], before))
        before += row["n"]
    base = F.broadcast(spark.createDataFrame(bases, "part long, base long"))
    placed = segments.join(base, "part").select("payload", (F.col("base") + F.col("first")).alias("first"))
    columns = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.mapInArrow(_read, columns)


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = new_path(spark, "tokens")
    write_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), path, added_tokens=True)
    return read_index(spark, path)
