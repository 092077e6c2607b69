"""Embedding near-dedup over a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards of bounded size. Every shard builds a graph (``flat_graph``), the
adjacency lists that a vector gets in its shards are united, and a range-expanding greedy search from the medoid of
each shard finds the links of its vectors, verified in double precision. A pair is counted in the first shard that its
two vectors share, so no pair leaves a task: a shard returns link counts and a spanning forest. Recall is audited
against brute force; if it is too low, the shards overlap more.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.llm import flat_graph
from tesselar.llm.components import connected_components
from tesselar.workspace import materialize

COSINE = 0.9
RECALL = 0.9
#: Vectors of a shard; a larger one is cut by further centroids, and into blocks where these do not tell its vectors apart.
SHARD = 2048
#: Nearest centroids that a vector is dealt to; the next is tried when the audited recall is too low.
OVERLAPS = (2, 4, 8)
DEPTH = 3
CENTROIDS, ROUNDS = 1024, 5
#: Numbers in the sample that centroids are fitted on, and in the vectors of the audit: the only rows on the driver.
SAMPLE_VALUES, AUDIT_ROWS = 2_000_000, 1000
#: Dot products in single precision may be lower than they are by this much.
SINGLE = 1e-3


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The direction of every vector in doubles and a key of it; null for a vector without one."""
    for batch in batches:
        column = batch.column("embedding")
        values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
        offsets, valid = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
        units: list[bytes | None] = []
        for at in range(len(column)):
            vector = values[offsets[at] : offsets[at + 1]] if valid[at] else values[:0]
            # Nulls are not a number here.
            largest = np.abs(vector).max(initial=0) if np.isfinite(vector).all() else 0
            if largest == 0:
                units.append(None)
                continue
            vector = vector / largest
            units.append((vector / np.sqrt(vector @ vector) + 0.0).tobytes())
        keys = [unit and hashlib.blake2b(unit, digest_size=16).digest() for unit in units]
        dims = [unit and len(unit) // 8 for unit in units]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("row"), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
            ["vec_id", "row", "key", "dim", "unit"],
        )


def _matrix(units: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = units.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def fit_centroids(sample: np.ndarray, count: int, cosine: float = COSINE, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``count`` unit centroids of ``sample``, none within ``cosine`` of another: a dense group has only one."""
    centroids = sample[:count]
    for _ in range(rounds):
        nearest = np.argmax(sample @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        centroids = np.where(norms[:, None] > 1e-9, sums / np.maximum(norms, 1e-9)[:, None], centroids)
    kept: list[int] = []
    for at, dots in enumerate(centroids @ centroids.T):
        if not kept or dots[kept].max() < cosine:
            kept.append(at)
    return centroids[kept]


def _ranked(centroids, dim: int, ranks: int):
    """The nearest centroids of every vector of ``dim`` numbers, nearest first; others have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = np.flatnonzero(batch.column("dim").to_numpy() == dim)
            ranked: list[list[int]] = [[] for _ in range(batch.num_rows)]
            if len(mine):
                order = np.argsort(-(_matrix(batch.column("unit").take(pa.array(mine))) @ centroids.value.T), axis=1)
                for at, row in zip(mine.tolist(), order[:, :ranks].tolist(), strict=True):
                    ranked[at] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("dim"), pa.array(ranked, pa.list_(pa.int32()))], ["node", "dim", "ranked"]
            )

    return run


def _build(unit: pa.Table) -> pa.Table:
    vectors = _matrix(unit.column("unit")).astype(np.float32)
    nodes = unit.column("node").to_numpy()
    edges = flat_graph.build(vectors)
    tails, places = np.nonzero(edges >= 0)
    ends = np.searchsorted(tails, np.arange(len(nodes) + 1))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(nodes[edges[tails, places]]))
    return pa.table({"node": pa.array(nodes), "near": lists})


def _local_edges(nodes: np.ndarray, lists: pa.Array) -> np.ndarray:
    """The lists as rows of ``nodes``, without those that are not among them, -1 behind the last."""
    order = np.argsort(nodes)
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    tail = np.repeat(np.arange(len(nodes)), np.diff(offsets))
    at = np.minimum(np.searchsorted(nodes[order], flat), len(nodes) - 1)
    here = nodes[order[at]] == flat
    tail, head = tail[here], order[at[here]]
    count = np.bincount(tail, minlength=len(nodes))
    edges = np.full((len(nodes), max(1, int(count.max(initial=0)))), -1)
    edges[tail, np.arange(len(tail)) - np.repeat(np.cumsum(count) - count, count)] = head
    return edges


def smallest_reachable(n: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each of ``n`` the smallest number that the given links lead to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[one], label[two])
        before = label.copy()
        np.minimum.at(label, one, low)
        np.minimum.at(label, two, low)
        label = label[label]
        if (label == before).all():
            return label


def _search(cosine: float):
    def run(unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks()
        nodes, size = unit.column("node").to_numpy(), unit.column("size").to_numpy()
        block, shard = unit.column("block").to_numpy(), unit.column("shard")[0].as_py()
        one, two = unit.column("one")[0].as_py(), unit.column("two")[0].as_py()
        exact = _matrix(unit.column("unit"))
        vectors = exact.astype(np.float32)
        # Of two blocks the vectors of one are looked for in the graph of the other.
        graph, asked = np.flatnonzero(block == two), np.flatnonzero(block == one)
        none = pa.table({"node": pa.array([], pa.int64()), "root": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        if not len(graph) or not len(asked):
            return none
        lists = unit.column("near").combine_chunks().take(pa.array(graph))
        edges = _local_edges(nodes[graph], lists)
        own = np.arange(len(graph)) if one == two else np.full(len(asked), -1)
        start = flat_graph.medoid(vectors[graph])
        pairs = []
        for at in range(0, len(asked), flat_graph.BATCH):
            part = slice(at, at + flat_graph.BATCH)
            row, found = flat_graph.range_search(vectors[graph], edges, start, vectors[asked[part]], own[part], cosine - SINGLE)
            a, b = asked[part][row], graph[found]
            pairs.append(np.unique(np.minimum(a, b) * len(nodes) + np.maximum(a, b)))
        a, b = np.divmod(np.unique(np.concatenate(pairs)), len(nodes))
        a, b = a[a != b], b[a != b]
        shards = unit.column("shards").combine_chunks()
        table = np.full((len(nodes), int(np.diff(shards.offsets.to_numpy()).max())), np.iinfo(np.int64).max)
        owner = np.repeat(np.arange(len(nodes)), np.diff(shards.offsets.to_numpy()))
        place = np.arange(len(owner)) - np.repeat(shards.offsets.to_numpy()[:-1] - shards.offsets[0].as_py(), np.diff(shards.offsets.to_numpy()))
        table[owner, place] = shards.flatten().to_numpy()
        links, left, right = np.zeros(len(nodes), np.int64), [], []
        for at in range(0, len(a), flat_graph.PORTION):
            x, y = a[at : at + flat_graph.PORTION], b[at : at + flat_graph.PORTION]
            linked = np.einsum("nd,nd->n", exact[x], exact[y]) >= cosine
            x, y = x[linked], y[linked]
            shared = np.where((table[x][:, :, None] == table[y][:, None, :]).any(axis=2), table[x], np.iinfo(np.int64).max)
            here = shared.min(axis=1) == shard
            x, y = x[here], y[here]
            np.add.at(links, x, size[y])
            np.add.at(links, y, size[x])
            left.append(x)
            right.append(y)
        if not links.any():
            return none
        root = smallest_reachable(len(nodes), np.concatenate(left), np.concatenate(right))
        told = np.flatnonzero(links)
        return pa.table({"node": nodes[told], "root": nodes[root[told]], "links": links[told]})

    return run


def _audit(queries, cosine: float):
    """Links of each query to the vectors of a batch, by brute force."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, matrix = queries.value
        for batch in batches:
            mine = np.flatnonzero(batch.column("dim").to_numpy() == matrix.shape[1])
            vectors = _matrix(batch.column("unit").take(pa.array(mine))) if len(mine) else np.empty((0, matrix.shape[1]))
            size, own = batch.column("size").to_numpy()[mine], batch.column("node").to_numpy()[mine]
            links = np.zeros(len(nodes), np.int64)
            for at in range(0, len(mine), 1024):
                part = slice(at, at + 1024)
                near = (matrix @ vectors[part].T >= cosine) & (nodes[:, None] != own[part])
                links += near @ size[part]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[links > 0]), pa.array(links[links > 0])], ["node", "exact"])

    return run


def _dealt(ranked: DataFrame, overlap: int, shard: int) -> DataFrame:
    """``node``, ``dim``, ``shard``, ``blocks``: the shards of every vector.

    A shard is the vectors whose nearest centroids begin alike. One above ``shard`` vectors is cut by the next centroid,
    in each of two ways; one that is still above it after ``DEPTH`` centroids has several blocks.
    """
    first = F.when(F.size("ranked") > 0, F.transform(F.slice("ranked", 1, overlap), lambda c: F.array(c)))
    members = ranked.withColumn("path", F.explode(F.coalesce(first, F.array(F.array().cast("array<int>")))))
    for _ in range(DEPTH):
        members = materialize(members, "shard-members")
        large = members.groupBy("dim", "path").agg(F.count("*").alias("n")).where(F.col("n") > shard)
        if large.isEmpty():
            break
        rest = F.slice(F.array_except("ranked", "path"), 1, 2)
        cut = F.when(F.col("n").isNotNull() & (F.size(rest) > 0), F.transform(rest, lambda c: F.concat("path", F.array(c))))
        split = F.explode(F.coalesce(cut, F.array("path"))).alias("path")
        members = members.join(large, ["dim", "path"], "left").select("node", "dim", "ranked", split)
    members = members.select("node", "dim", F.xxhash64("dim", "path").alias("shard")).distinct()
    sizes = members.groupBy("dim", "shard").agg(F.ceil(F.count("*") / shard).cast("int").alias("blocks"))
    return members.join(sizes, ["dim", "shard"])


def _in_units(rows: DataFrame, keys: list[str], function, shape: str) -> DataFrame:
    # A number of its own keeps units, small in bytes but not in work, from being joined into few tasks.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *keys).groupBy(*keys).applyInArrow(function, shape)


def _links(classes: DataFrame, ranked: DataFrame, overlap: int, cosine: float, shard: int) -> DataFrame:
    """``node``, ``root``, ``links`` of every shard."""
    dealt = materialize(_dealt(ranked, overlap, shard), "shards")
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    members = dealt.withColumn("block", block).join(classes.select("node", "unit", "size"), "node")
    built = _in_units(members.select("dim", "shard", "block", "node", "unit"), ["dim", "shard", "block"], _build, "node long, near array<long>")
    united = materialize(built, "shard-graphs").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    shards = dealt.groupBy("node").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    units = members.join(united, "node").join(shards, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")})
    units = units.select("dim", "shard", "one", "two", "block", "node", "unit", "size", "near", "shards")
    return materialize(_in_units(units, ["dim", "shard", "one", "two"], _search(cosine), "node long, root long, links long"), "vector-links")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, shard: int = SHARD) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id``, ``embedding``): ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Equal directions are one class, of which one vector is searched for; the counts are of rows. Vectors that are null,
    empty or zero, or hold a null or a number that is not finite, link with nothing, as do vectors of different
    lengths; their component is their own id. Rows with a null id are compared like others; a component has a null id
    only if no row of it has one. Repeated rows link with each other; other columns are ignored; an empty table gives
    no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    units = materialize(rows.mapInArrow(_units, "vec_id long, row long, key binary, dim int, unit binary"), "units")
    classes = units.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("row").alias("node"), F.min("vec_id").alias("class_id"), F.count("*").alias("size"), F.first("dim").alias("dim"), F.first("unit").alias("unit")
    )
    classes = materialize(classes, "vector-classes")

    common = classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    found = None
    if common is not None:
        dim, n = common["dim"], common["n"]
        context = spark.sparkContext
        by_chance = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("node", F.lit("sample")), "node")
        audited = by_chance.limit(max(1, min(AUDIT_ROWS, SAMPLE_VALUES // dim))).select("node", "unit").toArrow()
        queries = context.broadcast((audited.column("node").to_numpy(), _matrix(audited.column("unit"))))
        exact = classes.mapInArrow(_audit(queries, cosine), "node long, exact long").groupBy("node").agg(F.sum("exact").alias("exact"))
        exact = materialize(exact, "audit")
        for overlap in OVERLAPS:
            count = max(1, min(CENTROIDS, -(-2 * overlap * n // shard)))
            sample = by_chance.limit(max(1, min(64 * count, SAMPLE_VALUES // dim))).select("unit").toArrow()
            centroids = fit_centroids(_matrix(sample.column("unit")), count, cosine)
            ranks = min(len(centroids), max(OVERLAPS))
            placed = classes.mapInArrow(_ranked(context.broadcast(centroids), dim, ranks), "node long, dim int, ranked array<int>")
            found = _links(classes, placed, overlap, cosine, shard)
            told = found.groupBy("node").agg(F.sum("links").alias("links"))
            share = exact.join(told, "node", "left").agg(F.sum("exact").alias("exact"), F.sum("links").alias("links")).first()
            reached = (share["links"] or 0) / share["exact"] if share["exact"] else 1.0
            if reached >= recall:
                break
            logging.getLogger(__name__).warning("recall %.4f with %d shards for each vector", reached, overlap)
    if found is None:
        told = classes.select("key", F.lit(0).cast("long").alias("n_links"), F.col("class_id").alias("component_id"))
    else:
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        components = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
        ids = components.join(classes.select("node", "class_id"), "node").groupBy("component").agg(F.min("class_id").alias("least"))
        groups = components.join(ids, "component").select("node", "least")
        told = classes.join(counts, "node", "left").join(groups, "node", "left").select(
            "key", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("least", "class_id").alias("component_id")
        )
    result = units.select("vec_id", "key").join(told, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def op11_vector_links(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
