"""A robust-pruned flat graph over unit vectors, built and searched for many vectors at once in NumPy.

All rows are unit vectors; closeness is their dot product. Numbers of rows stand for nodes, -1 for no node.
"""

from __future__ import annotations

import numpy as np

DEGREE = 24
BEAM = 24
#: A neighbour goes when a kept one is nearer to it by this factor than the node itself.
ALPHA = 1.2
#: Rows searched for at once.
BATCH = 1024
#: Pairs looked at together.
PORTION = 1 << 17


def _distance(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * dots))


def medoid(vectors: np.ndarray) -> int:
    """The row nearest to the mean direction."""
    return int(np.argmax(vectors @ vectors.mean(axis=0)))


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """For each of ``nodes`` at most ``degree`` of its row of ``candidates``: the nearest first, without those that a
    chosen one covers."""
    order = np.sort(candidates, axis=1)
    repeated = np.zeros(order.shape, bool)
    repeated[:, 1:] = order[:, 1:] == order[:, :-1]
    candidates = np.where(repeated | (order == nodes[:, None]), -1, order)
    points = vectors[candidates]
    away = _distance(np.einsum("nd,ncd->nc", vectors[nodes], points))
    away[candidates < 0] = np.inf
    chosen = np.full((len(nodes), degree), -1)
    for place in range(degree):
        nearest = np.argmin(away, axis=1)
        rows = np.flatnonzero(np.isfinite(away[np.arange(len(nodes)), nearest]))
        if not len(rows):
            break
        nearest = nearest[rows]
        chosen[rows, place] = candidates[rows, nearest]
        between = _distance(np.einsum("nd,ncd->nc", points[rows, nearest], points[rows]))
        left = away[rows]
        left[alpha * between <= left] = np.inf
        left[np.arange(len(rows)), nearest] = np.inf
        away[rows] = left
    return chosen


def beam_search(vectors: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """For each query the ``beam`` nearest nodes that a greedy walk from ``start`` meets, nearest first."""
    n = len(queries)
    every = np.arange(n)
    nodes = np.full((n, beam), -1)
    dots = np.full((n, beam), -np.inf, vectors.dtype)
    done = np.ones((n, beam), bool)
    nodes[:, 0], dots[:, 0], done[:, 0] = start, queries @ vectors[start], False
    seen = np.zeros((n, len(vectors)), bool)
    seen[:, start] = True
    live = every
    while len(live):
        # The nearest node of each beam whose edges were not followed yet.
        waiting = np.where(done[live], -np.inf, dots[live])
        at = np.argmax(waiting, axis=1)
        any_left = np.isfinite(waiting[np.arange(len(live)), at])
        live, at = live[any_left], at[any_left]
        done[live, at] = True
        met = edges[nodes[live, at]]
        new = (met >= 0) & ~seen[live[:, None], met]
        rows, columns = np.nonzero(new)
        seen[live[rows], met[rows, columns]] = True
        found = np.full(met.shape, -np.inf, vectors.dtype)
        found[rows, columns] = np.einsum("nd,nd->n", queries[live[rows]], vectors[met[rows, columns]])
        all_nodes = np.concatenate([nodes[live], met], axis=1)
        all_dots = np.concatenate([dots[live], found], axis=1)
        all_done = np.concatenate([done[live], ~new], axis=1)
        best = np.argsort(-all_dots, axis=1, kind="stable")[:, :beam]
        nodes[live] = np.take_along_axis(all_nodes, best, 1)
        dots[live] = np.take_along_axis(all_dots, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1) | ~np.isfinite(dots[live])
    nodes[~np.isfinite(dots)] = -1
    return nodes


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 1) -> np.ndarray:
    """Out-edges of every row. Rows enter in batches that double: each finds its candidates by search in the graph so far."""
    n = len(vectors)
    edges = np.full((n, degree), -1)
    start = medoid(vectors)
    order = np.concatenate([[start], np.random.default_rng(seed).permutation(np.delete(np.arange(n), start))])
    first = 1
    while first < n:
        batch = order[first : first + min(first, BATCH)]
        found = beam_search(vectors, edges, start, vectors[batch], beam)
        # Rows of a batch do not see each other in the graph: the nearest few of the batch are candidates as well.
        among = vectors[batch] @ vectors[batch].T
        np.fill_diagonal(among, -np.inf)
        few = min(degree, len(batch) - 1)
        near = batch[np.argpartition(-among, few - 1, axis=1)[:, :few]] if few else np.empty((len(batch), 0), np.int64)
        edges[batch] = robust_prune(vectors, batch, np.concatenate([found, near], axis=1), degree, alpha)
        _add_reverse(vectors, edges, batch, alpha)
        first += len(batch)
    return edges


def _add_reverse(vectors: np.ndarray, edges: np.ndarray, batch: np.ndarray, alpha: float) -> None:
    """Edges back to the rows of ``batch``; a node with too many is pruned anew."""
    degree = edges.shape[1]
    ends = edges[batch]
    rows, columns = np.nonzero(ends >= 0)
    heads, tails = ends[rows, columns], batch[rows]
    # Nearest first for each head.
    order = np.lexsort((-np.einsum("nd,nd->n", vectors[heads], vectors[tails]), heads))
    heads, tails = heads[order], tails[order]
    nodes, begin, count = np.unique(heads, return_index=True, return_counts=True)
    place = np.arange(len(heads)) - np.repeat(begin, count)
    width = int(min(count.max(initial=0), 2 * degree))
    incoming = np.full((len(nodes), width), -1)
    kept = place < width
    incoming[np.repeat(np.arange(len(nodes)), count)[kept], place[kept]] = tails[kept]
    edges[nodes] = robust_prune(vectors, nodes, np.concatenate([edges[nodes], incoming], axis=1), degree, alpha)


class Neighbours:
    """The nodes at either end of every edge of a node."""

    def __init__(self, edges: np.ndarray):
        tail, place = np.nonzero(edges >= 0)
        head = edges[tail, place]
        code = np.unique(np.concatenate([tail * len(edges) + head, head * len(edges) + tail]))
        node, self.ends = np.divmod(code, len(edges))
        self.first = np.searchsorted(node, np.arange(len(edges) + 1))

    def of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every neighbour of each of ``nodes``: the place in ``nodes``, and the neighbour."""
        count = self.first[nodes + 1] - self.first[nodes]
        place = np.repeat(np.arange(len(nodes)), count)
        inside = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
        return place, self.ends[self.first[nodes][place] + inside]


def range_search(
    vectors: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, own: np.ndarray, least: float, beam: int = BEAM
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) whose dot product is at least ``least``, for all that the search meets.

    A greedy walk from ``start`` finds the first; from then on the edges of every node in range are followed, in both
    directions, until no new one is in range. ``own`` is the node of a query that is a row of the graph itself, or -1:
    it is in its own range.
    """
    neighbours = Neighbours(edges)
    found = beam_search(vectors, edges, start, queries, beam)
    row, place = np.nonzero(found >= 0)
    mine = np.flatnonzero(own >= 0)
    code = np.unique(np.concatenate([mine * len(vectors) + own[mine], row * len(vectors) + found[row, place]]))
    seen = np.zeros(len(queries) * len(vectors), bool)
    pairs = [np.empty(0, np.int64)]
    while len(code):
        seen[code] = True
        fresh = []
        # By portions: a group of near copies has many pairs.
        for at in range(0, len(code), PORTION):
            row, node = np.divmod(code[at : at + PORTION], len(vectors))
            near = np.einsum("nd,nd->n", queries[row], vectors[node]) >= least
            row, node = row[near], node[near]
            pairs.append(row * len(vectors) + node)
            place, met = neighbours.of(node)
            met = row[place] * len(vectors) + met
            fresh.append(np.unique(met[~seen[met]]))
        code = np.unique(np.concatenate(fresh))
    return np.divmod(np.concatenate(pairs), len(vectors))
