"""Quality rules by weak supervision.

Each rule votes for a text (1), against it (-1) or abstains (0). Expectation-maximisation over the counts of
vote patterns estimates, for each rule, how often it is right on good and on bad texts; the posterior
probability of a good text then decides, so one rule against the others removes nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselar.workspace import materialize

WORD_PATTERN = "[^ \\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
SHOUTS = "[A-ZÀ-ÖØ-Þ]{2,}"
ITERATIONS = 15
KEEP = 0.5
#: Votes in integers, so that every engine decides alike: rule -> (vote for, vote against).
RULES = {
    "symbols": ("100 * n_symbols <= 2 * word_chars", "100 * n_symbols > 10 * word_chars"),
    "repeats": ("100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 20 * n_words"),
    "lines": ("n_lines > 1 AND n_dup_lines = 0", "n_lines > 1 AND 100 * n_dup_lines > 30 * n_lines"),
    "shouts": ("100 * n_shouts <= 10 * n_words", "100 * n_shouts > 40 * n_words"),
    "word_length": (
        "word_chars >= 3 * n_words AND word_chars <= 12 * n_words",
        "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    ),
    "length": ("n_words >= 100", "n_words < 50"),
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _shifted(name: str) -> Column:
    return F.slice(name, 2, F.size(name))


def text_signals(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the counts the rules read, one row per row of ``documents``; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_PATTERN))
    rows = documents.select(
        "doc_id",
        F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)).alias("words"),
        lines.alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(SHOUTS)).cast("long").alias("n_shouts"),
    )
    counts = [
        "doc_id",
        "n_symbols",
        "n_shouts",
        "n_words",
        "word_chars",
        "n_lines",
        "n_dup_lines",
    ]
    rows = rows.select(
        "doc_id",
        "n_symbols",
        "n_shouts",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    # Hashes of three-word windows; the last two places hold shorter windows and go.
    rows = rows.select(*counts, "h", F.zip_with("h", _shifted("h"), lambda a, b: F.xxhash64(a, b)).alias("two"))
    rows = rows.select(*counts, F.zip_with("two", F.slice("h", 3, F.size("h")), lambda a, b: F.xxhash64(a, b)).alias("w"))
    rows = rows.select(*counts, F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))).alias("w"))
    repeated = F.size(F.array_distinct("w")) < F.size("w")
    rows = rows.select(*counts, F.when(repeated, F.col("w")).otherwise(F.slice("w", 1, 0)).alias("w"))
    # Equal windows are neighbours once sorted; the sort keeps each window's place.
    placed = F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    rows = rows.select(*counts, F.sort_array(placed).alias("s"))
    same_as_next = F.zip_with("s", _shifted("s"), lambda a, b: F.coalesce(a["x"] == b["x"], F.lit(False)))
    rows = rows.select(*counts, "s", same_as_next.alias("e"))
    marked = F.zip_with("s", "e", lambda a, e: F.struct(a["i"].alias("i"), e.alias("e")))
    before = F.concat(F.array(F.lit(False)), F.col("e"))
    at = F.zip_with(marked, before, lambda a, b: F.when(a["e"] | b, a["i"]))
    rows = rows.select(*counts, F.sort_array(F.array_compact(at)).alias("at"))
    covered = F.zip_with("at", _shifted("at"), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    n_repeat = F.aggregate(covered, F.lit(0), lambda total, x: total + x)
    return rows.select(*counts, n_repeat.cast("long").alias("n_repeat_words"))


def votes(signals: DataFrame) -> DataFrame:
    """The signals with one column ``vote_<rule>`` per rule."""
    columns = [
        F.expr(f"CASE WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END").alias(f"vote_{rule}")
        for rule, (good, bad) in RULES.items()
    ]
    return signals.select("*", *columns)


def fit_accuracies(patterns: list[tuple[tuple[int, ...], int]], iterations: int = ITERATIONS):
    """EM over (votes, count) patterns: prior of a good text, P(1 | good, voted) and P(-1 | bad, voted) per rule.

    Starts from a prior of 0.5 and accuracies of 0.8; every estimate is smoothed by one case of each kind.
    Without patterns the start values are returned.
    """
    rules = len(RULES)
    prior, good, bad = 0.5, [0.8] * rules, [0.8] * rules
    total = sum(count for _, count in patterns)
    for _ in range(iterations if total else 0):
        weight = [(vote, count, count * posterior(vote, prior, good, bad)) for vote, count in patterns]
        prior = (sum(g for _, _, g in weight) + 1) / (total + 2)
        for j in range(rules):
            voted = [(vote[j], count, g) for vote, count, g in weight if vote[j]]
            good[j] = (sum(g for v, _, g in voted if v > 0) + 1) / (sum(g for _, _, g in voted) + 2)
            bad[j] = (sum(c - g for v, c, g in voted if v < 0) + 1) / (sum(c - g for _, c, g in voted) + 2)
    return prior, good, bad


def posterior(vote: tuple[int, ...], prior: float, good: list[float], bad: list[float]) -> float:
    odds = math.log(prior / (1 - prior))
    for v, g, b in zip(vote, good, bad, strict=True):
        odds += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b) if v < 0 else 0.0
    return 1 / (1 + math.exp(-odds))


def quality_verdicts(documents: DataFrame, keep: float = KEEP) -> DataFrame:
    """Counts, base rules, probability of a good text and the verdict, one row per row of ``documents``.

    The accuracies come from the votes on all documents: one row per vote pattern, at most 3 to the power of the
    rules, reaches the driver. Null and empty texts have no words and fail the base rules; repeated rows and null
    ids are kept as they are; other columns are ignored; an empty table gives no rows.
    """
    voted = materialize(votes(text_signals(documents)), "quality-votes")
    names = [f"vote_{rule}" for rule in RULES]
    patterns = voted.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()
    prior, good, bad = fit_accuracies([(tuple(row[name] for name in names), row["n"]) for row in patterns])
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, g, b in zip(names, good, bad, strict=True):
        odds = odds + F.when(F.col(name) > 0, math.log(g / (1 - b))).when(F.col(name) < 0, math.log((1 - g) / b)).otherwise(0.0)
    probability = 1 / (1 + F.exp(-odds))
    return voted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.expr(BASE_FAILED).alias("base_failed"),
        F.round(probability, 6).alias("quality_probability"),
        (~F.expr(BASE_FAILED) & (probability >= keep)).alias("kept"),
    )


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _em_sql() -> str:
    """The same expectation-maximisation as unrolled common table expressions."""
    names = [f"vote_{rule}" for rule in RULES]
    odds = "ln(m.prior / (1 - m.prior))" + "".join(
        f" + CASE WHEN {n} > 0 THEN ln(m.g_{n} / (1 - m.b_{n})) WHEN {n} < 0 THEN ln((1 - m.g_{n}) / m.b_{n}) ELSE 0 END" for n in names
    )
    steps = ["m0 AS MATERIALIZED (SELECT CAST(0.5 AS DOUBLE) AS prior, " + ", ".join(f"CAST(0.8 AS DOUBLE) AS g_{n}, CAST(0.8 AS DOUBLE) AS b_{n}" for n in names) + ")"]
    for k in range(1, ITERATIONS + 1):
        steps.append(f"e{k} AS MATERIALIZED (SELECT p.*, p.n / (1 + exp(-({odds}))) AS g FROM patterns p, m{k - 1} m)")
        rates = ", ".join(
            f"(coalesce(sum(g) FILTER ({n} > 0), 0) + 1) / (coalesce(sum(g) FILTER ({n} <> 0), 0) + 2) AS g_{n}, "
            f"(coalesce(sum(n - g) FILTER ({n} < 0), 0) + 1) / (coalesce(sum(n - g) FILTER ({n} <> 0), 0) + 2) AS b_{n}"
            for n in names
        )
        steps.append(f"m{k} AS MATERIALIZED (SELECT (sum(g) + 1) / (sum(n) + 2) AS prior, {rates} FROM e{k})")
    return (
        f"patterns AS MATERIALIZED (SELECT {', '.join(names)}, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY ALL), "
        + ", ".join(steps)
        + f""" SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
       round(1 / (1 + exp(-({odds}))), 6) AS quality_probability,
       NOT ({BASE_FAILED}) AND 1 / (1 + exp(-({odds}))) >= {KEEP} AS kept FROM v, m{ITERATIONS} m"""
    )


_VOTES_SQL = ", ".join(f"CASE WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END AS vote_{rule}" for rule, (good, bad) in RULES.items())
OP2_SQL = rf"""
WITH t AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
x AS (SELECT r, unnest(w) AS a, unnest(range(len(w))) AS p FROM t),
y AS (SELECT r, p, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM x WINDOW o AS (PARTITION BY r ORDER BY p)),
z AS (SELECT r, p, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM y WHERE c IS NOT NULL),
q AS (SELECT r, count(DISTINCT p + i) AS n_repeat_words FROM z, (SELECT unnest([0, 1, 2]) AS i) WHERE n > 1 GROUP BY r),
s AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(regexp_extract_all(text, '{SHOUTS}')) AS BIGINT) AS n_shouts, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN l USING (r) LEFT JOIN q USING (r)),
v AS MATERIALIZED (SELECT *, {_VOTES_SQL} FROM s),
{_em_sql()}
"""
