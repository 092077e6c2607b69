"""Balancer members from add and remove requests, and requests spread over members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselar.functions.text import is_address
from tesselar.operators.ordered import CHUNK, Chunked, chunk, finish, key_totals, running
from tesselar.operators.skew import ROWS_PER_TASK, HotKeys, hot_keys_of, null_safe_join, rows_of_part, skew_join


def member_ip_check(requests: DataFrame) -> DataFrame:
    """Add ``status``: 200 for an IPv4 or IPv6 literal, else 400."""
    return requests.withColumn("status", F.when(is_address(F.col("ip")), 200).otherwise(400))


def active_members(events: DataFrame, rows_per_chunk: int = ROWS_PER_TASK) -> DataFrame:
    """The adds that survive all removes.

    A remove drops the oldest add of its address, or nothing. So an address keeps as many members
    as its count of adds less removes, never counted below zero, and these are its latest adds.
    """
    is_add = F.col("op") == "add"
    change = F.when(is_add, 1).otherwise(-1).cast("long")
    counted = running(
        chunk(events, ["balancer", "ip"], ["seq"], rows_per_chunk),
        sums={"_level": change, "_adds": is_add.cast("long")},
    )
    totals = finish(
        key_totals(
            counted,
            sums={"_balance": change, "_all_adds": is_add.cast("long")},
            minima={"_lowest": F.col("_level")},
        )
    )
    kept = F.col("_balance") - F.least(F.col("_lowest"), F.lit(0))
    newer_adds = F.col("_all_adds") - F.col("_adds")
    return totals.filter(is_add & (newer_adds < kept)).select("balancer", "seq", "ip")


def member_names(events: DataFrame, rows_per_chunk: int = ROWS_PER_TASK) -> DataFrame:
    """Name every add ``DC-0``, ``DC-1``, ... in order."""
    adds = events.filter(F.col("op") == "add")
    numbered = running(
        chunk(adds, ["balancer"], ["seq"], rows_per_chunk), sums={"_number": F.lit(1).cast("long")}
    )
    name = F.concat(F.lit("DC-"), F.col("_number") - 1)
    return finish(numbered).select("balancer", "seq", "ip", name.alias("name"))


def member_list(
    members: DataFrame, rows_per_chunk: int = ROWS_PER_TASK, balancers: DataFrame | None = None
) -> DataFrame:
    """One comma-joined list of member addresses per balancer, in add order, with a closing line feed.

    The list is the result row itself; it is put together from texts built per chunk. ``balancers`` names the balancers
    to answer for; without members the list is the line feed alone.
    """
    chunked = chunk(members, ["balancer"], ["seq"], rows_per_chunk).df
    url = F.concat(F.lit("http://"), F.col("ip"))

    def in_order(order: str, text: str):
        pairs = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text))))
        return F.array_join(F.transform(pairs, lambda pair: pair[text]), ",")

    texts = chunked.withColumn("url", url).groupBy("balancer", CHUNK).agg(
        in_order("seq", "url").alias("text")
    )
    lists = texts.groupBy("balancer").agg(in_order(CHUNK, "text").alias("members"))
    if balancers is not None:
        lists = null_safe_join(balancers.select("balancer").distinct(), lists, ["balancer"], "left")
    return lists.withColumn("members", F.concat(F.coalesce("members", F.lit("")), F.lit("\n")))


def round_robin_assign(
    requests: DataFrame, members: DataFrame, rows_per_chunk: int = ROWS_PER_TASK
) -> DataFrame:
    """The k-th request of a balancer goes to member ``k mod n`` of its fixed member list."""

    def numbered(chunked: Chunked, out: str) -> DataFrame:
        counted = finish(running(chunked, sums={out: F.lit(1).cast("long")}))
        return counted.withColumn(out, F.col(out) - 1)

    slots = numbered(chunk(members, ["balancer"], ["seq"], rows_per_chunk), "slot").select(
        "balancer", "slot", "ip"
    )
    sizes = members.groupBy("balancer").agg(F.count("*").alias("_size"))
    asked = chunk(requests, ["balancer"], ["seq"], rows_per_chunk)
    join = lambda facts, lookup, key, hot: skew_join(
        facts, lookup, key, ["seq"], "inner", rows_per_chunk, hot
    )
    sized = join(numbered(asked, "_k"), sizes, ["balancer"], asked.hot)
    placed = sized.withColumn("slot", F.col("_k") % F.col("_size")).drop("_k", "_size")
    hot_slots = _hot_slots(asked.hot, slots, sizes, rows_per_chunk)
    return join(placed, slots, ["balancer", "slot"], hot_slots)


def _hot_slots(hot: HotKeys, slots: DataFrame, sizes: DataFrame, rows_per_task: int) -> HotKeys:
    """Members of hot balancers that get more requests than one task takes, by arithmetic."""
    if not hot:
        return hot
    rows_per_task = rows_of_part(hot.rows, rows_per_task)
    busy = null_safe_join(sizes, hot.to_join("balancer", "key_rows"), ["balancer"], "inner").select(
        "balancer", F.ceil(F.col("key_rows") / F.col("_size")).alias("key_rows")
    )
    busy = busy.filter(F.col("key_rows") > rows_per_task)
    counts = slots.select("balancer", "slot").join(busy, "balancer")
    return hot_keys_of(counts, ["balancer", "slot"], rows_per_task)
