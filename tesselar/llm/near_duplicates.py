"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets verify them.

Every row gets a written number. Texts with the same words form one class, of which one row (the smallest ``doc_id``,
nulls last, then the smallest number) is compared. Bands and rows
are chosen for the wanted recall at the threshold. A pair is verified only in the first band that it shares, so each
is counted once. A large bucket is cut into blocks and every pair of blocks is a unit of work of its own. A
unit returns link counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.llm.components import connected_components
from tesselar.llm.grams import digest, gram_hashes, mix, normalised
from tesselar.llm.training import free_name
from tesselar.workspace import materialize

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Hash functions at most; with them the longest bands that reach the recall are taken.
HASHES = 128
#: Texts and n-grams of a block.
BLOCK_TEXTS = 512
BLOCK_GRAMS = 1_000_000


def banding(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows per band: a pair at the threshold shares a band with probability ``recall`` or more."""
    best = None
    for rows in range(1, hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("more hash functions are needed for this recall")
    return best


def band_hashes(grams: np.ndarray, bands: int, rows: int, seed: int = 1) -> np.ndarray:
    """One 64-bit value per band, from the minima of ``bands * rows`` hash functions of the n-grams."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    minima = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), 1024):
        part = grams[start : start + 1024, None] * factors + offsets
        np.minimum(minima, part.min(axis=0), out=minima)
    minima = minima.reshape(bands, rows)
    value = np.arange(bands, dtype=np.uint64)
    for row in range(rows):
        value = mix(value * np.uint64(31) + minima[:, row])
    return value.view(np.int64)


def _signatures(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, values = [], [], []
            columns = [batch.column(name).to_pylist() for name in ("doc_id", "row", "text")]
            for doc_id, row, text in zip(*columns, strict=True):
                words = normalised(text)
                grams = gram_hashes(words, n)
                keys.append(digest(words) if words else digest((f" {doc_id}" if doc_id is not None else f" row {row}").encode()))
                sizes.append(len(grams))
                values.append(band_hashes(grams, bands, rows).tolist() if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(values, pa.list_(pa.int64()))],
                ["doc_id", "row", "key", "n_grams", "bands"],
            )

    return run


def _gram_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [gram_hashes(normalised(text), n).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "grams"])

    return run


def _units(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of each (band, value, one, two) from a partition sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        columns = [table.column(name).to_numpy() for name in names]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = [0, *cuts.tolist()]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            yield table.slice(start, end - start)
        rest = table.slice(edges[-1])
    if rest is not None and rest.num_rows:
        yield rest


UNIT = ["band", "value", "one", "two"]


class _Unit:
    """Members of a bucket, or of two of its blocks; pairs that share no earlier band."""

    def __init__(self, table: pa.Table):
        node = table.column("node").to_numpy()
        self.node, first = np.unique(node, return_index=True)
        self.rows = first
        self.band = int(table.column("band")[0].as_py())
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        block = table.column("block").to_numpy()[first]
        self.left = np.flatnonzero(block == one)
        self.right = None if one == two else np.flatnonzero(block == two)
        flat = table.column("bands").combine_chunks()
        self.bands = flat.flatten().to_numpy().reshape(len(node), -1)[first]

    def new_pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """For each member its partners in this unit that it meets here first."""
        for at, a in enumerate(self.left):
            others = self.left[at + 1 :] if self.right is None else self.right
            if len(others):
                known = (self.bands[others, : self.band] == self.bands[a, : self.band]).any(axis=1)
                if not known.all():
                    yield a, others[~known]


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the members that have a new pair in their unit."""
    for table in _units(batches, UNIT):
        unit = _Unit(table)
        used = np.zeros(len(unit.node), bool)
        for a, others in unit.new_pairs():
            used[a] = True
            used[others] = True
        if used.any():
            yield from table.take(unit.rows[used]).to_batches()


def _forest(n: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``n`` along the given links."""
    label = np.arange(n)
    while len(one):
        low = np.minimum(label[one], label[two])
        before = label.copy()
        np.minimum.at(label, one, low)
        np.minimum.at(label, two, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _verify(threshold: float):
    def links(unit: _Unit, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(s) for s in sets])
        one, two = [], []
        for a, others in unit.new_pairs():
            # Sizes alone rule out most pairs of different length.
            low, high = np.minimum(sizes[a], sizes[others]), np.maximum(sizes[a], sizes[others])
            others = others[low >= threshold * high - 1e-9]
            one.append(np.full(len(others), a))
            two.append(others)
        one = np.concatenate(one) if one else np.empty(0, int)
        two = np.concatenate(two) if two else np.empty(0, int)
        if len(one) <= 64:
            shared = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(one, two, strict=True)], int)
        else:
            shared = _intersections(sets)[one, two]
        linked = shared >= threshold * (sizes[one] + sizes[two] - shared) - 1e-9
        return one[linked], two[linked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _units(batches, UNIT):
            unit = _Unit(table)
            grams = table.column("grams")
            sets = [np.frombuffer(grams[int(row)].as_py(), np.uint64) for row in unit.rows]
            one, two = links(unit, sets)
            if not len(one):
                continue
            counts = np.bincount(one, minlength=len(sets)) + np.bincount(two, minlength=len(sets))
            root = _forest(len(sets), one, two)
            told = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unit.node[told]), pa.array(unit.node[root[told]]), pa.array(counts[told].astype(np.int64))],
                ["node", "root", "links"],
            )

    return run


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of 0/1 matrices over the n-grams that occur more than once."""
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    gram, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = count[column] > 1
    renumbered = np.cumsum(count > 1) - 1
    member, column = member[kept], renumbered[column[kept]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    for start in range(0, int((count > 1).sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[member[a:b], column[a:b] - start] = 1
        total += part @ part.T
    return np.rint(total).astype(int)


def _numbered(documents: DataFrame, row: str) -> DataFrame:
    """The rows as written, each with a number of its own."""
    return materialize(documents.withColumn(row, F.monotonically_increasing_id()), "numbered")


def _groups(rows: DataFrame, threshold: float, n: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """``doc_id`` and ``key`` of each of ``rows`` (``doc_id``, ``row``, ``text``), and one row per class.

    A class has its ``key``, ``node`` and ``class_id`` (number and id of its first row), ``n_links``, and of the first
    row of its group ``group`` and ``group_id``.
    """
    bands, size = banding(threshold, recall)
    signatures = rows.mapInArrow(_signatures(n, bands, size), "doc_id long, row long, key binary, n_grams long, bands array<long>")
    signatures = materialize(signatures, "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    classes = signatures.groupBy("key").agg(first, F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"))
    classes = classes.select("key", F.col("first.row").alias("node"), F.col("first.doc_id").alias("class_id"), "n_grams", "bands")
    classes = materialize(classes, "classes")
    texts = classes.where(F.col("bands").isNotNull())

    entries = texts.select("node", "n_grams", F.posexplode("bands").alias("band", "value"))
    buckets = entries.groupBy("band", "value").agg(F.count("*").alias("n"), F.sum("n_grams").alias("grams")).where("n > 1")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    members = (
        entries.join(buckets, ["band", "value"])
        .select("node", "band", "value", blocks.alias("blocks"))
        .select("*", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int").alias("block"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", "band", "value", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    )
    members = members.join(texts.select("node", "bands"), "node")
    shape = "node long, band int, value long, block int, one int, two int, bands array<long>"
    needed = members.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(_needed, shape)
    needed = materialize(needed, "candidates")

    wanted = needed.select("node").distinct()
    sets = rows.select(F.col("row").alias("node"), "text").join(wanted, "node").mapInArrow(_gram_sets(n), "node long, grams binary")
    units = needed.join(sets, "node").repartition(*UNIT).sortWithinPartitions(*UNIT)
    links = materialize(units.mapInArrow(_verify(threshold), "node long, root long, links long"), "links")

    components = connected_components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    members = components.join(classes.select("node", "class_id"), "node")
    first = F.min(F.struct(F.col("class_id").isNull().alias("no_id"), "class_id", "node")).alias("first")
    groups = components.join(members.groupBy("component").agg(first), "component")
    groups = groups.select("node", F.col("first.node").alias("group"), F.col("first.class_id").alias("group_id"))
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    told = (
        classes.select("key", "node", "class_id")
        .join(counts, "node", "left")
        .join(groups, "node", "left")
        .select(
            "key",
            "node",
            "class_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("group", "node").alias("group"),
            # A group without any id has a null here, as its class has.
            F.coalesce("group_id", "class_id").alias("group_id"),
        )
    )
    return signatures.select("doc_id", "key"), told


def near_duplicates(documents: DataFrame, threshold: float = THRESHOLD, n: int = GRAM, recall: float = RECALL) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``class_id``, ``n_links``, ``group_id``.

    ``class_id`` is the smallest ``doc_id`` with the same word sequence, ``n_links`` the number of other classes
    whose n-gram sets have Jaccard similarity ``threshold`` or more, ``group_id`` the smallest ``class_id`` that
    links lead to. Texts of fewer than n words are one n-gram. Null, empty and blank texts have no n-grams: each is
    its own class without links. Rows with a null ``doc_id`` are compared like others; an id is null only if no row of
    the class or group has one. Repeated rows give repeated rows; other columns are ignored.
    """
    signatures, told = _groups(_numbered(documents.select("doc_id", "text"), "row"), threshold, n, recall)
    return signatures.join(told, "key").select("doc_id", "class_id", "n_links", "group_id")


def one_of_each_group(documents: DataFrame, threshold: float = THRESHOLD, n: int = GRAM, recall: float = RECALL) -> DataFrame:
    """Of each group the row of the smallest ``doc_id``, nulls last; of several with that id the first as written.

    Blank texts are one group for each ``doc_id``, and each its own where it is null.
    """
    row = free_name(documents, "row")
    numbered = _numbered(documents, row)
    told = _groups(numbered.select("doc_id", F.col(row).alias("row"), "text"), threshold, n, recall)[1]
    kept = told.where(F.col("node") == F.col("group")).select(F.col("node").alias(row))
    return numbered.join(kept, row, "left_semi").select(*documents.columns)


def op6_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
