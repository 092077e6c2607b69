"""Chat formatting by quotation linking.

Lines of a message that begin with marks of quotation are its quotes, the number of marks is their level. Normalised
quoted passages (a run of lines of one level, and each line of it) are hashed and joined to the messages of the same
conversation that hold them as their own text. The message quoted at level 1 is the parent; parents give root and
depth, and the own text without quotes is what remains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselar.workspace import materialize

QUOTE = r"^(?:[ \t]*>)+[ \t]?"


def _normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\r\n]+", " "))


def parse_quotes(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``body``, ``n_quoted`` and the array ``passages`` of (level, size, hash).

    ``body`` is the text without quoted lines, without blank lines at its ends. A null text is empty.
    """
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    level = lambda line: F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), "[^>]+", ""))
    parsed = F.transform(
        lines, lambda line: F.struct(level(line).alias("level"), F.regexp_replace(line, QUOTE, "").alias("line"))
    )
    rows = messages.select("conv_id", "turn", "role", parsed.alias("lines"))
    own = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"])
    quoted = F.filter("lines", lambda x: x["level"] > 0)
    rows = rows.select("conv_id", "turn", "role", F.trim(F.array_join(own, "\n"), F.lit(" \n")).alias("body"), quoted.alias("q"), "lines")
    # Runs of one level: the level goes before each run, blank lines of the run count as blanks.
    runs = F.aggregate(
        "lines",
        F.array().cast("array<struct<level:int,text:string>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["level"] == x["level"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(x["level"].alias("level"), F.concat_ws(" ", F.element_at(done, -1)["text"], x["line"]).alias("text"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["level"].alias("level"), x["line"].alias("text"))))),
    )
    single = F.transform("q", lambda x: F.struct(x["level"].alias("level"), x["line"].alias("text")))
    units = F.concat(F.filter(runs, lambda x: x["level"] > 0), single)
    units = F.transform(units, lambda x: F.struct(x["level"].alias("level"), _normalised(x["text"]).alias("text")))
    units = F.array_distinct(F.filter(units, lambda x: x["text"] != ""))
    passages = F.transform(
        units, lambda x: F.struct(x["level"].alias("level"), F.length(x["text"]).alias("size"), F.md5(x["text"]).alias("hash"))
    )
    return rows.select("conv_id", "turn", "role", "body", F.size("q").cast("long").alias("n_quoted"), passages.alias("passages"))


def link_quotations(messages: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, turn, role, body, n_quoted, n_linked, parent_turn, root_turn, depth``.

    A quoted passage belongs to the first message of its conversation that has it as its whole own text or as a
    line of it, if that is earlier than the quoting one. At each level the message with the most quoted characters
    counts (the later of equals); ``n_linked`` is the number of levels that are linked, ``parent_turn`` the message
    of level 1. A message without one is a root of depth 0. Sorted by (conv_id, root_turn, turn) every message
    follows the one it replies to.

    Null and empty texts have an empty body and quote nothing. Rows with a null ``conv_id`` or ``turn`` are roots
    without links. Repeated (conv_id, turn) rows are kept each with the links of all of them. Other columns are ignored.
    """
    parsed = materialize(parse_quotes(messages), "parsed-messages")
    lines = F.transform(F.split("body", "\n"), lambda line: _normalised(line))
    own = F.array_distinct(F.filter(F.concat(F.array(_normalised(F.col("body"))), lines), lambda x: x != ""))
    originals = (
        parsed.select("conv_id", "turn", F.explode_outer(F.transform(own, lambda x: F.md5(x))).alias("hash"))
        .where("hash IS NOT NULL")
        .groupBy("conv_id", "hash")
        .agg(F.min("turn").alias("origin"))
    )
    quotes = parsed.select("conv_id", "turn", F.explode_outer("passages").alias("p")).where("p IS NOT NULL")
    quotes = quotes.select("conv_id", "turn", "p.level", "p.size", "p.hash").distinct()
    linked = (
        quotes.join(originals, ["conv_id", "hash"])
        .where(F.col("origin") < F.col("turn"))
        .groupBy("conv_id", "turn", "level", "origin")
        .agg(F.sum("size").alias("size"))
        .groupBy("conv_id", "turn", "level")
        .agg(F.max_by("origin", F.struct("size", "origin")).alias("origin"))
        .groupBy("conv_id", "turn")
        .agg(F.count("*").alias("n_linked"), F.max(F.when(F.col("level") == 1, F.col("origin"))).alias("parent_turn"))
    )
    linked = materialize(linked, "quote-links")
    roots = _roots(linked.where("parent_turn IS NOT NULL").select("conv_id", "turn", "parent_turn"))
    return (
        parsed.join(linked, ["conv_id", "turn"], "left")
        .join(roots, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            "body",
            "n_quoted",
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            "parent_turn",
            F.coalesce("root_turn", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        )
    )


def _roots(parents: DataFrame) -> DataFrame:
    """``root_turn`` and ``depth`` of every reply by pointer doubling.

    A reply takes part until its pointer reaches a root: as many rounds as its depth has binary digits, and one more.
    """
    active = materialize(parents.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth")), "reply-roots")
    settled = None
    while True:
        known = active if settled is None else active.unionByName(settled)
        further = known.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more"))
        joined = active.join(further, ["conv_id", "root_turn"], "left").select(
            "conv_id",
            "turn",
            F.coalesce("next", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        joined = materialize(joined, "reply-roots")
        at_root = joined.where("NOT moved").drop("moved")
        settled = at_root if settled is None else settled.unionByName(at_root)
        active = joined.where("moved").drop("moved")
        if active.isEmpty():
            return settled


def derived_messages(conversations: DataFrame) -> DataFrame:
    """Each turn as a reply by mail: the turn two before it quoted twice, the one before it quoted once, its own text."""

    def quoted(back: int) -> DataFrame:
        marks = F.regexp_replace(F.concat(F.lit("> " * back), "text"), "\n", "\n" + "> " * back)
        return conversations.select("conv_id", (F.col("turn") + back).alias("turn"), marks.alias(f"q{back}"))

    rows = conversations.select("conv_id", "turn", "role", "text")
    for back in (1, 2):
        rows = rows.join(quoted(back), ["conv_id", "turn"], "left")
    return rows.select("conv_id", "turn", "role", F.concat_ws("\n", "q2", "q1", "text").alias("text"))


def op5_quotation_links(spark, sf_dir: str) -> DataFrame:
    """The links of all conversations, derived as mail; the parent of a root is given as -1."""
    linked = link_quotations(derived_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return linked.withColumn("parent_turn", F.coalesce("parent_turn", F.lit(-1)).cast("long"))


_NORMAL = r"trim(regexp_replace(lower({}), '[ \t\r\n]+', ' ', 'g'))"
OP5_SQL = rf"""
WITH RECURSIVE m AS MATERIALIZED (SELECT c.conv_id, c.turn, c.role, concat_ws(chr(10), '> > ' || replace(b.text, chr(10), chr(10) || '> > '),
    '> ' || replace(a.text, chr(10), chr(10) || '> '), c.text) AS text FROM conversations c
    LEFT JOIN conversations a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1
    LEFT JOIN conversations b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2),
l AS MATERIALIZED (SELECT conv_id, turn, role, p, x, length(regexp_replace(regexp_extract(x, '^([ \t]*>)+[ \t]?'), '[^>]+', '', 'g')) AS level,
    regexp_replace(x, '^([ \t]*>)+[ \t]?', '') AS line
    FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS p FROM m)),
b AS MATERIALIZED (SELECT conv_id, turn, any_value(role) AS role, coalesce(trim(string_agg(line, chr(10) ORDER BY p) FILTER (level = 0), ' ' || chr(10)), '') AS body,
    CAST(count(*) FILTER (level > 0) AS BIGINT) AS n_quoted FROM l GROUP BY conv_id, turn),
r AS (SELECT *, p - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY p) AS run FROM l WHERE level > 0),
q AS (SELECT DISTINCT conv_id, turn, level, t FROM (
    SELECT conv_id, turn, level, {_NORMAL.format("string_agg(line, ' ' ORDER BY p)")} AS t FROM r GROUP BY conv_id, turn, level, run
    UNION ALL SELECT conv_id, turn, level, {_NORMAL.format("line")} FROM r) WHERE t <> ''),
o AS (SELECT conv_id, t, min(turn) AS origin FROM (SELECT conv_id, turn, {_NORMAL.format("body")} AS t FROM b
    UNION ALL SELECT conv_id, turn, {_NORMAL.format("unnest(string_split(body, chr(10)))")} FROM b) WHERE t <> '' GROUP BY conv_id, t),
k AS (SELECT q.conv_id, q.turn, level, origin, sum(length(t)) AS size FROM q JOIN o USING (conv_id, t) WHERE origin < q.turn GROUP BY ALL),
f AS MATERIALIZED (SELECT conv_id, turn, count(*) AS n_linked, max(origin) FILTER (level = 1) AS parent_turn
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY size DESC, origin DESC) AS n FROM k) WHERE n = 1 GROUP BY conv_id, turn),
up AS (SELECT conv_id, turn, parent_turn AS root_turn, 1 AS depth FROM f WHERE parent_turn IS NOT NULL
    UNION ALL SELECT up.conv_id, up.turn, f.parent_turn, up.depth + 1 FROM up JOIN f ON f.conv_id = up.conv_id AND f.turn = up.root_turn WHERE f.parent_turn IS NOT NULL),
d AS (SELECT conv_id, turn, max(depth) AS depth, arg_max(root_turn, depth) AS root_turn FROM up GROUP BY conv_id, turn)
SELECT b.conv_id, b.turn, b.role, b.body, b.n_quoted, CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, CAST(coalesce(parent_turn, -1) AS BIGINT) AS parent_turn,
    coalesce(d.root_turn, b.turn) AS root_turn, CAST(coalesce(d.depth, 0) AS BIGINT) AS depth
FROM b LEFT JOIN f USING (conv_id, turn) LEFT JOIN d USING (conv_id, turn)
"""
