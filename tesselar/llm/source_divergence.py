"""Source divergence audit: how far the word use of the sources of a language lies apart, and by which words.

Token-start pointer sort: every task builds pointers to the word starts over Arrow's text buffers and sorts those of a
slice by a multikey quicksort whose digits are eight bytes wide. Equal words are then one run, and the runs give the
documents and the occurrences by source. Only runs leave a task. All divergences are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselar.llm.word_pointers import Words, byte_set, slices
from tesselar.workspace import materialize

MIN_DOCS = 10
TOP_TERMS = 10
#: ASCII letters and every byte of a character beyond ASCII.
LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Fixed value of the contract: probabilities are multiples of one in a thousand million.
SCALE = 1_000_000_000
#: Sources and terms of a block of the pair sums.
BLOCK_SOURCES, BLOCK_TERMS = 64, 4096
RUNS = "lang string, term string, docs long, entries array<struct<source: string, n: long>>"


def sorted_runs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words in byte order, and for each place the number of its run of equal words."""
    every = np.arange(len(words))
    key = words.eight(every, 0)
    order = np.argsort(key)
    key = key[order]
    run = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if len(words) else every
    depth = 1
    while True:
        # Runs of more than one word of which some go on behind the bytes compared.
        longer = np.flatnonzero(words.length[order] > 8 * depth)
        size = np.bincount(run, minlength=1)
        live_run = np.zeros(len(size), bool)
        live_run[run[longer]] = True
        live = np.flatnonzero((live_run & (size > 1))[run]) if len(run) else every
        if not len(live):
            return order, run
        key = words.eight(order[live], depth)
        place = np.lexsort((key, run[live]))
        order[live], key = order[live][place], key[place]
        new = np.zeros(len(run), np.int64)
        new[live[1:]] = (key[1:] != key[:-1]) & (run[live[1:]] == run[live[:-1]])
        run = run + np.cumsum(new)
        depth += 1


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language and term of a slice: its documents, and its occurrences by source."""
    for part in slices(batches):
        names = pa.table({name: part.column(name) for name in ("lang", "source")}).to_pandas()
        groups = names.drop_duplicates().sort_values(["lang", "source"], ignore_index=True)
        group_of = names.merge(groups.reset_index(), "left", ["lang", "source"])["index"].to_numpy()
        langs, lang_of = np.unique(groups["lang"].to_numpy(), return_inverse=True)
        words = Words(part.column("text"), LETTERS)
        if not len(words):
            continue
        order, run = sorted_runs(words)
        # Occurrences per (run, document), then per (run, group); groups are sorted by language.
        in_row, n = np.unique(run * part.num_rows + words.row[order], return_counts=True)
        run_of, row_of = np.divmod(in_row, part.num_rows)
        in_group, start, docs = np.unique(run_of * len(groups) + group_of[row_of], return_index=True, return_counts=True)
        # Documents of a run come by row, not by group: sum by group.
        place = np.searchsorted(in_group, run_of * len(groups) + group_of[row_of])
        total = np.bincount(place, n, len(in_group)).astype(np.int64)
        run_of, group = np.divmod(in_group, len(groups))
        lang = lang_of[group]
        edge = np.flatnonzero(np.concatenate([[True], (np.diff(run_of) != 0) | (np.diff(lang) != 0)]))
        first = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
        entries = pa.StructArray.from_arrays(
            [pa.array(groups["source"].to_numpy()[group], pa.string()), pa.array(total)], ["source", "n"]
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs[lang[edge]], pa.string()),
                words.texts(order[first[run_of[edge]]]),
                pa.array(np.add.reduceat(docs, edge).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.append(edge, len(in_group)), pa.int32()), entries),
            ],
            ["lang", "term", "docs", "entries"],
        )


def _probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact."""
    wide = "decimal(38,0)"
    share = F.call_function("div", F.lit(SCALE).cast(wide) * (count.cast("decimal(20,0)") + 2), (total + 2 * kept).cast(wide))
    return F.lit(1) + share


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); p and q are at most SCALE + 1, so 64 bits hold the square."""
    return (p - q) ** 2 // (p + q)


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(cells: pd.DataFrame) -> pd.DataFrame:
    """Summed divergences of the sources of two blocks over the terms of a bucket, and the number of these terms.

    The row of a source without a term has the probability of terms that the source lacks.
    """
    one, two = cells["one"].iloc[0], cells["two"].iloc[0]
    default = cells[cells["term"].isna()]
    sources = default["source"].to_numpy()
    index = pd.Index(sources)
    found = cells[cells["term"].notna()]
    terms, column = np.unique(found["term"].to_numpy(str), return_inverse=True)
    table = np.repeat(default["p"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    table[index.get_indexer(found["source"]), column] = found["p"].to_numpy(np.int64)
    block = default["block"].to_numpy()
    right = np.flatnonzero(block == two)
    parts = []
    for a in np.flatnonzero(block == one):
        others = right[right != a] if one != two else right[right > a]
        value = divergence(table[a], table[others]).sum(axis=1)
        low, high = np.minimum(sources[a], sources[others]), np.maximum(sources[a], sources[others])
        parts.append(pd.DataFrame({"low": low, "high": high, "value": value}))
    sums = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"low": [], "high": [], "value": []})
    return sums.assign(lang=cells["lang"].iloc[0], seen=len(terms))[["lang", "low", "high", "value", "seen"]]


def term_counts(documents: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` of the terms in at least ``min_docs`` documents of their language."""
    rows = documents.select(*[F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source")], "text")
    runs = materialize(rows.mapInArrow(_runs, RUNS), "term-runs")
    kept = runs.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    entries = runs.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "term", F.inline("entries"))
    return entries.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


def source_divergence(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: the other sources of the language by summed divergence. Part ``term``: the ``top`` terms that the
    source uses more than its language does. Null texts, languages and sources count as empty; an empty text has no
    terms, its group still has its pairs; repeated rows count each; of equal values the smaller item comes first; other
    columns are ignored; an empty table gives no rows.
    """
    counts = materialize(term_counts(documents, min_docs), "term-counts")
    groups = documents.select(*[F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source")]).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    langs = of_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang")
    groups = groups.na.fill(0, ["total", "kept", "lang_total"])
    p0 = F.when(F.col("kept") > 0, _probability(F.lit(0), F.col("total"), F.col("kept")))
    blocks = F.ceil(F.col("n_sources") / BLOCK_SOURCES).cast("int")
    groups = groups.withColumns(
        {
            "p0": p0,
            "blocks": blocks,
            "buckets": F.ceil(F.col("kept") / BLOCK_TERMS).cast("int"),
            "block": F.pmod(F.xxhash64("source"), blocks).cast("int"),
        }
    )
    groups = materialize(groups, "source-groups")

    told = counts.join(groups.select("lang", "source", "total", "kept", "lang_total", "blocks", "buckets", "block"), ["lang", "source"])
    told = materialize(told.withColumn("p", _probability(F.col("n"), F.col("total"), F.col("kept"))), "term-shares")
    cells = told.select("lang", "source", "term", "p", "block", "blocks", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"))
    absent = groups.where("kept > 0").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "block", "blocks",
        F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"),
    )
    units = cells.unionAll(absent).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("lang", "bucket", "source", "term", "p", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    sums = units.groupBy("lang", "bucket", "one", "two").applyInPandas(_pair_sums, "lang string, low string, high string, value long, seen long")
    sums = sums.groupBy("lang", "low", "high").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    sums = materialize(sums, "pair-sums")

    # The other sources are the result itself, one row each.
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = groups.select("lang", "source", "kept", "p0").join(other, "lang").where(F.col("source") != F.col("item"))
    pairs = pairs.withColumns({"low": F.least("source", "item"), "high": F.greatest("source", "item")})
    pairs = pairs.join(sums, ["lang", "low", "high"], "left")
    # Terms that no source of the two blocks has are in no sum.
    unseen = (F.col("kept") - F.coalesce("seen", F.lit(0))) * _divergence(F.col("p0"), F.col("q0"))
    value = F.when(F.col("kept") > 0, F.coalesce("value", F.lit(0)) + unseen).otherwise(0).cast("long")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))

    terms = told.join(of_lang, ["lang", "term"]).withColumn("q", _probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")))
    terms = terms.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _divergence(F.col("p"), F.col("q")).cast("long").alias("value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionAll(ranked)


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
l AS (SELECT lang, count(*) AS kept, sum(lang_n) AS lang_total FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
g AS MATERIALIZED (SELECT lang, source, coalesce(total, 0) AS total, coalesce(kept, 0) AS kept, coalesce(lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN t USING (lang, source) LEFT JOIN l USING (lang)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * g.kept) AS p,
  1 + {SCALE}::HUGEINT * (k.lang_n + 2) // (g.lang_total + 2 * g.kept) AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM f)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
