"""Benchmark decontamination by winnowing.

Of every ``window - k + 1`` consecutive k-gram hashes the smallest is kept, so two texts that share ``window``
consecutive words keep a common fingerprint there. Fingerprints of documents and benchmark items are joined;
each hit names a diagonal (document position minus item position), and the words along the diagonal are
compared, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselar.llm.training import free_name
from tesselar.workspace import materialize

#: Words are runs of a-z (after lower-casing A-Z), 0-9 and characters beyond ASCII.
WORD_PATTERN = "[0-9a-z\\x{80}-\\x{10FFFF}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 10
GRAM = 4
#: Fingerprints of 40 bytes each that may be sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def text_words(text: Column, lowered: Column | None = None) -> Column:
    """The words of a text; a null text has none."""
    lowered = F.translate(text, UPPER, UPPER.lower()) if lowered is None else lowered
    return F.regexp_extract_all(F.coalesce(lowered, F.lit("")), F.lit(WORD_PATTERN), F.lit(0))


def folded_words(text: Column) -> Column:
    """As ``text_words``, but other letters are lower-cased too: cheaper, and equal words stay equal."""
    return text_words(text, F.replace(F.lower(text), F.lit("ς"), F.lit("σ")))


def _zip_shifted(rows: DataFrame, kept: list[str], name: str, shift: int, pair) -> DataFrame:
    """Combine each element of the array with the one ``shift`` places behind it."""
    shifted = F.slice(name, 1 + shift, F.size(name))
    return rows.select(*kept, F.zip_with(name, shifted, pair).alias(name))


def fingerprints(texts: DataFrame, window: int, k: int) -> DataFrame:
    """Winnowed fingerprints of the column ``words``: its other columns with ``fp`` and ``at``.

    Hashes of k-grams and minima of runs are built by doubling. The low 3 bits of a hash hold its distance from
    the end of the run (``window - k < 8``), so of equal hashes the rightmost counts.
    """
    run = window - k + 1
    kept = [name for name in texts.columns if name != "words"]
    # No filter on these arrays: it would be pushed below and compute them twice.
    rows = texts.select(*kept, F.transform("words", lambda w: F.xxhash64(w)).alias("v"))
    size = 1
    while size < k:
        shift = min(size, k - size)
        rows = _zip_shifted(rows, kept, "v", shift, lambda a, b: F.xxhash64(a, b))
        size += shift
    rows = rows.select(*kept, F.transform("v", lambda x: x.bitwiseAND(F.lit(-8))).alias("v"))
    size = 1
    while size < run:
        shift = min(size, run - size)
        rows = _zip_shifted(rows, kept, "v", shift, lambda a, b: F.least(a + F.lit(shift), b))  # noqa: B023
        size += shift
    # Runs that reach beyond the end go; a run that keeps the fingerprint of the run before it adds none.
    rows = rows.select(*kept, F.slice("v", 1, F.greatest(F.size("v") - window + 1, F.lit(0))).alias("v"))
    place = lambda x: x.bitwiseAND(F.lit(7))
    rows = rows.select(
        *kept,
        F.zip_with(
            "v",
            F.concat(F.array(F.lit(None).cast("long")), F.col("v")),
            lambda x, before: F.when(before.isNull() | (place(x) != place(before) + 1), x),
        ).alias("v"),
    )
    rows = rows.select(*kept, F.posexplode_outer("v").alias("s", "x")).where(F.col("x").isNotNull())
    low = F.col("x").bitwiseAND(F.lit(7)).cast("int")
    return rows.select(*kept, (F.col("x") - low).alias("fp"), (F.col("s") + (run - 1) - low).alias("at"))


def _gram(window: int) -> int:
    return min(GRAM, window)


def contamination(documents: DataFrame, benchmark: DataFrame, *carry: str, window: int = WINDOW) -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, the columns of ``carry``, and what benchmark items it holds.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window of all of them,
    an item without words has none. Adds ``n_words``, ``n_hit`` (words inside any occurrence of a window),
    ``n_items``, ``items_sha256`` (of the item ids, sorted as strings and joined by commas) and ``contaminated``.

    Null and empty texts have no words and are clean. Repeated documents give repeated rows, repeated items
    count once per ``item_id``; rows with a null ``doc_id`` or null ``item_id`` are compared like others, a null
    ``item_id`` hits words but joins no id list. Other columns are ignored unless carried.
    """
    items = (
        benchmark.select("item_id", text_words(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .distinct()
        .select("*", F.least(F.size("words"), F.lit(window)).alias("t"))
        .select("*", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "words").alias("item"))
    )
    items = materialize(items, "benchmark-items")
    lengths = sorted(row["t"] for row in items.select("t").distinct().collect())  # at most ``window`` values
    # A written number tells rows apart that share an id or have none.
    columns = list(dict.fromkeys(["doc_id", "text", *carry]))
    number = free_name(documents.select(*columns), "llm_number")
    documents = materialize(documents.select(*columns).withColumn(number, F.monotonically_increasing_id()), "numbered")
    texts = documents.select(F.col(number).alias("number"), folded_words(F.col("text")).alias("words"))
    found = None
    for length in lengths:
        windows = items.where(F.col("t") == length).select("item", folded_words(F.array_join("words", " ")).alias("words"))
        marks = fingerprints(windows, length, _gram(length))
        marks = materialize(marks.withColumnRenamed("at", "item_at"), "benchmark-marks")
        if marks.count() <= BROADCAST_ROWS:
            marks = F.broadcast(marks)
        hits = (
            fingerprints(texts, length, _gram(length))
            .join(marks, "fp")
            .select("number", "item", (F.col("at") - F.col("item_at")).alias("diagonal"))
            .distinct()
        )
        found = hits if found is None else found.unionAll(hits)
    kept = [F.col("d.doc_id"), *[F.col(f"d.{name}") for name in carry]]
    if found is None:
        joined = documents.alias("d").select(*kept, F.col("d.text").alias("llm_text"))
        joined = joined.withColumn("hits", F.lit(None).cast("array<struct<item_id:string,diagonal:int,t:int,words:array<string>>>"))
    else:
        hit = F.struct(F.col("item_id").cast("string").alias("item_id"), "diagonal", "t", "words")
        per_document = found.join(items, "item").groupBy("number").agg(F.collect_set(hit).alias("hits"))
        joined = (
            documents.alias("d")
            .join(per_document.alias("c"), F.col(f"d.{number}") == F.col("c.number"), "left")
            .select(*kept, F.col("d.text").alias("llm_text"), F.col("c.hits").alias("hits"))
        )
    return _verdict(joined)


def _verdict(joined: DataFrame) -> DataFrame:
    """Compare words along each diagonal: ``llm_text`` and ``hits`` become the result columns."""
    kept = [name for name in joined.columns if name not in ("llm_text", "hits")]
    # The exact lower-casing is slow and needed only where fingerprints met; the number of words is the same.
    lowered = F.when(F.col("hits").isNull(), F.lower("llm_text")).otherwise(F.translate("llm_text", UPPER, UPPER.lower()))
    split = joined.select(*kept, text_words(F.col("llm_text"), lowered).alias("llm_words"), "hits")

    def occurrences(hit: Column) -> Column:
        first = F.greatest(F.lit(0), -hit["diagonal"])
        length = F.least(F.size(hit["words"]), F.size("llm_words") - hit["diagonal"]) - first
        there = F.slice("llm_words", first + hit["diagonal"] + 1, F.greatest(length, F.lit(0)))
        here = F.slice(hit["words"], first + 1, F.greatest(length, F.lit(0)))
        equal = F.zip_with(there, here, lambda a, b: a == b)
        starts = F.transform(
            F.array(equal),  # one element: names the array for the inner function
            lambda same: F.filter(
                F.sequence(F.lit(0), F.size(same) - hit["t"]),
                lambda s: ~F.array_contains(F.slice(same, s + 1, hit["t"]), False),
            ),
        )[0]
        starts = F.when(length >= hit["t"], starts).otherwise(F.array().cast("array<int>"))
        base = first + hit["diagonal"]
        return F.transform(starts, lambda s: F.sequence(s + base, s + base + hit["t"] - 1))

    spans = split.select(
        *kept,
        F.size("llm_words").cast("long").alias("n_words"),
        F.when(
            F.col("hits").isNotNull(),
            F.transform("hits", lambda hit: F.struct(hit["item_id"].alias("item_id"), F.flatten(occurrences(hit)).alias("at"))),
        ).alias("spans"),
    )
    found = F.filter(F.coalesce("spans", F.array().cast("array<struct<item_id:string,at:array<int>>>")), lambda s: F.size(s["at"]) > 0)
    spans = spans.select(*kept, "n_words", found.alias("spans"))
    ids = F.array_compact(F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"]))))
    n_hit = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: s["at"])))).cast("long")
    return spans.select(*kept, "n_words", n_hit.alias("n_hit"), ids.alias("llm_ids")).select(
        *kept,
        "n_words",
        "n_hit",
        F.size("llm_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("llm_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` that hold no window of a benchmark item, with all their columns."""
    row = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("llm_row")
    checked = contamination(documents.select("doc_id", "text", row), benchmark, "llm_row", window=window)
    return checked.where(~F.col("contaminated")).select("llm_row.*")


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contamination(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ip AS (SELECT item_id, least(len(w), 10) AS t, unnest(w) AS x, unnest(range(len(w))) AS p, r FROM (SELECT *, row_number() OVER () AS r FROM i)),
iw AS (SELECT item_id, t, list(x) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM ip),
ig AS (SELECT DISTINCT item_id, t, l[1:t] AS g FROM iw WHERE len(l) >= t),
dp AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS p FROM d),
dw AS (SELECT doc_id, p, list(x) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM dp),
hits AS (SELECT doc_id, item_id, p AS s, n.t FROM dw CROSS JOIN (SELECT DISTINCT t FROM ig) n JOIN ig ON ig.t = n.t AND ig.g = dw.l[1:n.t]),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + t)) AS p FROM hits) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
