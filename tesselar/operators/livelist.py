"""The live member list: adds, removes and health probes act on one list per balancer.

An add appends an entry, a remove drops the oldest entry of its address, a failed probe drops all entries of its
address. Requests with an address that is none are rejected and do nothing. Per address this is a queue: its length
changes by ``max(length + a, b)`` over any stretch of events, so stretches sum up and long histories are cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.functions.text import is_address
from tesselar.operators.folds import Fold, chunks_for, fold_in_order, since
from tesselar.operators.membership import member_list, member_names
from tesselar.operators.skew import ROWS_PER_TASK, find_hot_keys

#: Kinds of events: an ok probe or an unknown operation does nothing.
NOTHING, ADD, REMOVE, FAIL = range(4)
#: More than any number of events of a chunk.
FAR = 1 << 40


class QueueFold(Fold):
    """State: (adds, entries left, failed probes) of an address. Summary: the adds, the length as ``max(length + a, b)``
    (``a`` is None after a failed probe) and the failed probes.

    Adds columns: ``number`` of an entry among the adds of its address (on adds, and on removes that drop an entry);
    ``fails`` before the row; ``left_at`` and ``reason`` of entries that leave within the chunk; ``open`` on entries and
    events that may have their other end in another chunk.
    """

    start = (0, 0, 0)
    shape = "number LONG, fails LONG, left_at LONG, reason STRING, open BOOLEAN"

    def _queue(self, kind: np.ndarray, first: np.ndarray, state: tuple[int, int, int]):
        """Adds, queue length and failed probes after every row; the queue's sum and lowest sum since its last reset."""
        n = len(kind)
        here, entered = np.arange(n), first == 0
        fail = kind == FAIL
        fails = since(fail.astype(np.int64), first)
        # Stretches end with a failed probe or with the key.
        begins = np.zeros(n, bool)
        begins[first] = True
        begins[1:] |= fail[:-1]
        stretch = np.cumsum(begins)
        begin = np.flatnonzero(begins)[stretch - 1] if n else here
        change = np.where(kind == ADD, 1, np.where(kind == REMOVE, -1, 0))
        total = since(change, begin)
        lowest = np.minimum.accumulate(total - stretch * FAR) + stretch * FAR
        length = total - np.minimum(lowest, np.where(entered & (begin == 0), -state[1], 0))
        length[fail] = 0
        adds = since((kind == ADD).astype(np.int64), first) + np.where(entered, state[0], 0)
        return adds, length, fails + np.where(entered, state[2], 0), total, lowest

    def summary(self, rows: pa.Table):
        kind = rows.column("_kind").to_numpy()
        adds, length, fails, total, lowest = self._queue(kind, np.zeros(len(kind), np.int64), self.start)
        if fails[-1]:
            return int(adds[-1]), None, int(length[-1]), int(fails[-1])
        return int(adds[-1]), int(total[-1]), int(total[-1] - lowest[-1]), 0

    def compose(self, state, summary):
        adds, change, floor, fails = summary
        length = floor if change is None else max(state[1] + change, floor)
        return state[0] + adds, length, state[2] + fails

    def apply(self, rows: pa.Table, first: np.ndarray, state) -> dict[str, pa.Array]:
        kind, seq = rows.column("_kind").to_numpy(), rows.column("seq").to_numpy()
        n, here = len(kind), np.arange(len(kind))
        adds, length, fails, _, _ = self._queue(kind, first, state)
        gone = adds - length
        before = np.where(here == first, np.where(first == 0, state[0] - state[1], 0), np.concatenate([[0], gone[:-1]]))
        add, drops, fail = kind == ADD, (kind == REMOVE) & (gone > before), kind == FAIL
        number = np.where(add, adds, gone)
        # The remove that drops an entry has the entry's number; both grow along a key.
        code = first * FAR + number
        pops, entries = np.flatnonzero(drops), np.flatnonzero(add)
        at = np.minimum(np.searchsorted(code[pops], code[entries]), max(len(pops) - 1, 0))
        removed = code[pops][at] == code[entries] if len(pops) else np.zeros(len(entries), bool)
        left = np.full(n, -1)
        left[entries[removed]] = pops[at[removed]]
        # Else the next failed probe of the key drops it.
        next_fail = np.minimum.accumulate(np.where(fail, here, n)[::-1])[::-1]
        stays = entries[~removed]
        found = next_fail[stays]
        same = (found < n) & (first[np.minimum(found, n - 1)] == first[stays])
        left[stays[same]] = found[same]
        evicted = (left >= 0) & fail[np.maximum(left, 0)]
        earlier = first == 0
        head_fail = fail & earlier & (since(fail.astype(np.int64), first) == 1)
        open_ = (add & (left < 0) & (first == first[-1])) | (drops & earlier & (number <= state[0])) | head_fail
        return {
            "number": pa.array(number, mask=~(add | drops)),
            "fails": pa.array(fails - fail),
            "left_at": pa.array(seq[np.maximum(left, 0)], mask=left < 0),
            "reason": pa.array(np.where(evicted, "evicted", "removed").astype(object), pa.string(), mask=left < 0),
            "open": pa.array(open_),
        }


def live_members(events: DataFrame, rows_per_chunk: int = ROWS_PER_TASK) -> DataFrame:
    """Every entry that was on a list: ``balancer``, ``seq`` (its add), ``ip``, ``name``, ``left_at``, ``reason``.

    ``events`` has ``balancer``, ``seq``, ``op`` (``add``, ``remove``, ``probe``), ``ip`` and ``status`` (of probes; null
    is an exception). ``name`` counts the accepted adds of the balancer from ``DC-0``. ``left_at`` is the ``seq`` of the
    remove or failed probe that drops the entry, null while it is on the list; ``reason`` is ``removed`` or ``evicted``.
    """
    failed = (F.col("op") == "probe") & ~F.coalesce(F.col("status") == 200, F.lit(False))
    kind = F.when(F.col("op") == "add", ADD).when(F.col("op") == "remove", REMOVE).when(failed, FAIL).otherwise(NOTHING)
    valid = events.where(is_address(F.col("ip"))).select("balancer", "ip", F.col("seq").cast("long").alias("seq"), kind.alias("_kind"))
    valid = valid.where(F.col("_kind") != NOTHING)
    hot = find_hot_keys(valid, ["balancer", "ip"], rows_per_chunk)
    chunks = chunks_for(events.sparkSession, hot.rows, rows_per_chunk)
    folded = fold_in_order(valid, ["balancer", "ip"], ["seq"], QueueFold(), chunks)

    entries = folded.where(F.col("_kind") == ADD)
    far = folded.where(F.col("open"))
    key = ["balancer", "ip"]
    # The two ends of an entry that outlives its chunk: its remove has its number, its failed probe the failures before it.
    removes = far.where(F.col("_kind") == REMOVE).select(*key, "number", F.col("seq").alias("_removed_at"))
    # One a chunk at most.
    fails = far.where(F.col("_kind") == FAIL).select(*key, "fails", F.col("seq").alias("_evicted_at"))
    waiting = entries.where("open").join(removes, [*key, "number"], "left").join(F.broadcast(fails), [*key, "fails"], "left")
    reason = F.when(F.col("_removed_at").isNotNull(), "removed").when(F.col("_evicted_at").isNotNull(), "evicted")
    waiting = waiting.withColumns({"left_at": F.coalesce("_removed_at", "_evicted_at"), "reason": reason})
    columns = [*key, "seq", "left_at", "reason"]
    told = entries.where(~F.col("open")).select(*columns).unionByName(waiting.select(*columns))
    names = member_names(valid.withColumn("op", F.when(F.col("_kind") == ADD, "add")), rows_per_chunk)
    return told.join(names, ["balancer", "seq", "ip"]).select("balancer", "seq", "ip", "name", "left_at", "reason")


def live_member_list(events: DataFrame, rows_per_chunk: int = ROWS_PER_TASK) -> DataFrame:
    """The answer of every balancer to a check after all events, see ``member_list``; also of those with no member."""
    entries = live_members(events, rows_per_chunk).where(F.col("left_at").isNull())
    return member_list(entries.select("balancer", "seq", "ip"), rows_per_chunk, events.select("balancer").distinct())
