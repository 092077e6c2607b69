"""A HAT-trie over word ids: hash containers of sequences below a shallow trie, burst as they grow.

A node has its children by ranges of the next word. A container serves a range of words; when it holds too many
different sequences, its range is cut in two, and a word that fills a container alone gets a node of its own. Whole
subtrees are taken out as sorted rows to free memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tesselar.llm.grams import BASE, mix

#: Different sequences of a container.
BURST = 1 << 15


def row_codes(rows: np.ndarray) -> np.ndarray:
    """64 bits for each row of word ids."""
    code = rows[:, 0]
    for column in range(1, rows.shape[1]):
        code = mix(code * np.uint64(BASE) + rows[:, column])
    return code


def sum_equal(rows: np.ndarray, counts: np.ndarray, in_order: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The different rows with their summed counts, in the order of their words if asked to, else in that of their hash."""
    if not len(rows):
        return rows, counts

    def equal_neighbours(order: np.ndarray) -> np.ndarray:
        return np.all([c[order[1:]] == c[order[:-1]] for c in rows.T], axis=0)

    if not in_order:
        code = row_codes(rows)
        order = np.argsort(code)
        same = equal_neighbours(order)
        # Different rows of one hash may lie between equal ones: then the words decide.
        in_order = bool(((code[order[1:]] == code[order[:-1]]) & ~same).any())
    if in_order:
        order = np.lexsort(rows.T[::-1])
        same = equal_neighbours(order)
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    return rows[order[first]], np.add.reduceat(counts[order], first)


class _Container:
    def __init__(self):
        self.rows: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        self.rows.append(rows)
        self.counts.append(counts)
        self.size += len(rows)

    def pack(self, in_order: bool = False) -> tuple[np.ndarray, np.ndarray]:
        rows, counts = sum_equal(np.concatenate(self.rows), np.concatenate(self.counts), in_order)
        self.rows, self.counts, self.size = [rows], [counts], len(rows)
        return rows, counts

    def sorted_rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.size:
            yield self.pack(in_order=True)


class _Node:
    def __init__(self, burst: int):
        self.burst = burst
        #: The first word of every child's range, and for a node the only one.
        self.low = np.zeros(1, np.uint64)
        self.children: list[_Container | _Node] = [_Container()]

    @property
    def size(self) -> int:
        return sum(child.size for child in self.children)

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        child = np.searchsorted(self.low, rows[:, 0], "right") - 1
        order = np.argsort(child, kind="stable")
        child = child[order]
        edges = [0, *(np.flatnonzero(np.diff(child)) + 1).tolist(), len(child)] if len(child) else [0]
        # From the last child on, as a burst moves those behind it.
        for start, end in reversed(list(zip(edges[:-1], edges[1:], strict=True))):
            at, chosen = int(child[start]), order[start:end]
            target = self.children[at]
            if isinstance(target, _Node):
                target.add(rows[chosen, 1:], counts[chosen])
                continue
            target.add(rows[chosen], counts[chosen])
            if target.size > 2 * self.burst:
                target.pack()
                if target.size > self.burst:
                    self._burst(at)

    def _burst(self, at: int) -> None:
        rows, counts = self.children[at].rows[0], self.children[at].counts[0]
        words = np.sort(rows[:, 0])
        if words[0] == words[-1]:
            node = _Node(self.burst)
            node.add(rows[:, 1:], counts)
            low, children = [words[0]], [node]
            if self.low[at] < words[0]:
                low, children = [self.low[at], *low], [_Container(), *children]
            behind = int(words[0]) + 1
            if behind < 1 << 64 and (at + 1 == len(self.low) or behind < int(self.low[at + 1])):
                low, children = [*low, np.uint64(behind)], [*children, _Container()]
        else:
            middle = words[len(words) // 2]
            if middle == words[0]:
                middle = words[np.searchsorted(words, middle, "right")]
            left = rows[:, 0] < middle
            low, children = [self.low[at], middle], [_Container(), _Container()]
            children[0].add(rows[left], counts[left])
            children[1].add(rows[~left], counts[~left])
        self.low = np.concatenate([self.low[:at], np.array(low, np.uint64), self.low[at + 1 :]])
        self.children[at : at + 1] = children

    def sorted_rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for word, child in zip(self.low, self.children, strict=True):
            if isinstance(child, _Node):
                for rows, counts in child.sorted_rows():
                    yield np.column_stack([np.full(len(rows), word), rows]), counts
            else:
                yield from child.sorted_rows()


class HatTrie:
    """Counts of sequences of two or more 64-bit word ids, all of one length."""

    def __init__(self, burst: int = BURST):
        self.root = _Node(burst)

    @property
    def size(self) -> int:
        """Sequences held; some may still be held more than once."""
        return self.root.size

    def add(self, rows: np.ndarray) -> None:
        self.root.add(rows, np.ones(len(rows), np.int64))

    def take(self, leave: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Take out whole subtrees below the root, the largest first, until ``leave`` sequences stay: rows in order, counts."""
        sizes = np.array([child.size for child in self.root.children])
        order = np.argsort(-sizes, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        chosen = np.sort(order[(sizes.sum() - before > leave) & (sizes[order] > 0)])
        runs = []
        for at in chosen.tolist():
            subtree = _Node(self.root.burst)
            subtree.low, subtree.children = self.root.low[at : at + 1], [self.root.children[at]]
            runs.extend(subtree.sorted_rows())
            self.root.children[at] = _Container()
        if not runs:
            return None
        return np.concatenate([rows for rows, _ in runs]), np.concatenate([counts for _, counts in runs])
