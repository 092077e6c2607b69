"""Toxicity by a weighted grammar of finite-state transducers.

A lexicon transducer maps words to classes: insults (words and word beginnings with weights learned from labelled
documents), threats, targets, negation, reported speech, quotation marks, clause ends. Small transducers for
negation, reported speech, targets and threats are composed into one machine that reads the classes of a clause and
weighs each match by its context. The clause weights of a document, not its single words, make its score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesselar.llm.training import held_out, labelled_sample, with_field

#: Labelled rows that the lexicon and the calibration are fitted on, at most.
SAMPLE = 12_000
#: A unit must be in so many toxic documents, and its weight stand so many standard errors above ``LEAST_WEIGHT``.
LEAST_DOCS, ERRORS = 3, 1.64
PREFIXES = (4, 5, 6)
LEAST_WEIGHT = 2.0
PREDICT = 0.5
MEMORY = 400_000

OTHER, END, NEGATION, REPORT, TARGET, THREAT, QUOTE, INSULT = range(8)
#: Function words and threats in English, German, French and Spanish.
NEGATIONS = "not no never nor without nicht kein keine nie ohne pas jamais sans aucun nunca sin ningún tampoco"
REPORTS = "said says wrote called reported claims sagte sagt schrieb nannte dit écrit appelé dijo dice escribió llamó"
TARGETS = "you your yours they them du dich dir ihr euch deine tu te toi vous votre vos tú ti vosotros usted ustedes ellos"
THREATS = "kill killing murder hurt destroy shoot töten ermorden umbringen tuer assassiner frapper matar asesinar golpear"
THREAT_WEIGHT = 1.0
TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]|[\"«»“”„]")


class Transducer:
    """Reads classes; every match (insult or threat) is multiplied by the factor of the state it is read in."""

    def __init__(self, states: int, moves: dict[tuple[int, int], int], default: list[int], factors: list[float]):
        self.states, self.factors = states, factors
        self.next = [[moves.get((s, c), default[s]) for c in range(INSULT + 1)] for s in range(states)]

    def compose(self, other: Transducer) -> Transducer:
        """Both machines read the same input; the factors are multiplied."""
        both = Transducer.__new__(Transducer)
        both.states = self.states * other.states
        both.factors = [a * b for a in self.factors for b in other.factors]
        both.next = [
            [self.next[s][c] * other.states + other.next[t][c] for c in range(INSULT + 1)]
            for s in range(self.states)
            for t in range(other.states)
        ]
        return both


def grammar() -> Transducer:
    """State 0 is the start of a clause; its end leads back there."""
    # A negation weakens what follows within three words.
    negation = Transducer(
        4, {(s, NEGATION): 3 for s in range(4)} | {(s, END): 0 for s in range(4)}, [0, 0, 1, 2], [1.0, 0.4, 0.4, 0.4]
    )
    # Reported speech lasts to the end of the clause, a quotation to its closing mark, over sentence ends within it.
    reported = Transducer(
        3,
        {(0, REPORT): 1, (0, QUOTE): 2, (1, QUOTE): 2, (2, QUOTE): 0, (1, END): 0},
        [0, 1, 2],
        [1.0, 0.7, 0.7],
    )
    # Whoever is addressed before makes a match worse.
    target = Transducer(2, {(0, TARGET): 1, (1, END): 0}, [0, 1], [1.0, 1.25])
    # A threat makes later insults of the clause worse, and the other way round.
    threat = Transducer(2, {(0, THREAT): 1, (0, INSULT): 1, (1, END): 0}, [0, 1], [1.0, 1.1])
    return negation.compose(reported).compose(target).compose(threat)


class Lexicon(dict):
    """Token -> class, or ``INSULT`` plus the place of its weight; bounded memory of looked-up tokens."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.units = {unit: INSULT + at for at, unit in enumerate(weights)}
        self.weights = list(weights.values())
        self.fixed = dict.fromkeys(".!?;\n", END) | dict.fromkeys('"«»“”„', QUOTE)
        for words, kind in ((TARGETS, TARGET), (REPORTS, REPORT), (NEGATIONS, NEGATION), (THREATS, THREAT)):
            self.fixed |= dict.fromkeys(words.split(), kind)

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        found = self.fixed.get(token)
        if found is None:
            units = [u for u in (token, *(f"{token[:n]}*" for n in PREFIXES if len(token) >= n)) if u in self.units]
            found = self.units[max(units, key=lambda u: self.weights[self.units[u] - INSULT])] if units else OTHER
        self[token] = found
        return found


def clause_weights(tokens: list[int], machine: Transducer, lexicon: Lexicon) -> list[float]:
    """The weight of every clause with a match."""
    result, state, total, matched = [], 0, 0.0, False
    for token in tokens:
        kind = min(token, INSULT)
        if kind == INSULT or kind == THREAT:
            weight = THREAT_WEIGHT if kind == THREAT else lexicon.weights[token - INSULT]
            total += weight * machine.factors[state]
            matched = True
        elif kind == END and matched:
            result.append(total)
            total, matched = 0.0, False
        state = machine.next[state][kind]
    if matched:
        result.append(total)
    return result


FEATURES = 5


def document_features(text: str | None, machine: Transducer, lexicon: Lexicon) -> list[float]:
    tokens = [lexicon[token] for token in TOKEN.findall((text or "").lower())]
    matches = sum(token >= THREAT and token != QUOTE for token in tokens)
    if not matches:
        return [0.0] * FEATURES
    weights = clause_weights(tokens, machine, lexicon)
    return [
        max(weights),
        float(np.log1p(sum(weights))),
        float(np.log1p(1000 * sum(weights) / len(tokens))),
        float(np.log1p(len(weights))),
        1.0,
    ]


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and word beginnings whose share among toxic documents is far above that among others.

    The weight is the log ratio of both shares. What is rare is judged by its standard error, alike at every size of
    the sample; the units are as many as the texts of the sample, which is bounded, give.
    """
    tokens = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))
    words = sample.select("label", F.xxhash64("text").alias("x"), F.array_distinct(tokens).alias("w")).dropDuplicates(["label", "x"])
    starts = [
        F.transform("w", lambda t: F.when(F.length(t) >= n, F.concat(F.left(t, F.lit(n)), F.lit("*"))))  # noqa: B023
        for n in PREFIXES
    ]
    units = words.select("label", F.array_distinct(F.concat("w", *starts)).alias("units"))
    totals = words.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = totals["toxic"], totals["n"] - totals["toxic"]
    counts = (
        units.select("label", F.explode_outer("units").alias("unit"))
        .where("unit IS NOT NULL")
        .groupBy("unit")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("n"))
    )
    weight = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("n") + 0.5) / (clean + 1.0))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("n") + 0.5))
    found = (
        counts.where(F.col("t") >= LEAST_DOCS)
        .select("unit", weight.alias("weight"), (weight - ERRORS * error).alias("sure"))
        .where(F.col("sure") >= LEAST_WEIGHT)
        .orderBy("unit")
        .collect()
    )
    return {row["unit"]: row["weight"] for row in found}


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights and intercept by Newton's method; without rows an intercept of zero."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * l2
    penalty[-1, -1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
    return w


class ToxicityModel:
    """A lexicon and the calibration of clause weights; small enough to go with every task."""

    def __init__(self, weights: dict[str, float], calibration: list[float]):
        self.weights, self.calibration = weights, calibration

    def score(self, features: np.ndarray) -> np.ndarray:
        w = np.asarray(self.calibration)
        return 1 / (1 + np.exp(-np.clip(features @ w[:-1] + w[-1], -30, 30)))


def _features(weights: dict[str, float], model: ToxicityModel | None, text_at: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, lexicon = grammar(), Lexicon(weights)
        for batch in batches:
            rows = [document_features(text, machine, lexicon) for text in batch.column(text_at).to_pylist()]
            table = np.asarray(rows, float).reshape(len(rows), FEATURES)
            value = pa.array(model.score(table)) if model else pa.array(rows, pa.list_(pa.float64()))
            others = [n for n in batch.schema.names if n != text_at or model]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in others], value], [*others, out])

    return run


def fit_toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from at most ``sample`` labelled rows outside the held-out fold."""
    rows = labelled_sample(documents, labels, "toxic", sample)
    weights = learn_lexicon(rows)
    fitted = rows.select("label", "text").mapInArrow(_features(weights, None, "text", "x"), "label int, x array<double>").toPandas()
    x = np.array(fitted["x"].tolist(), float).reshape(len(fitted), FEATURES)
    return ToxicityModel(weights, fit_logistic(x, fitted["label"].to_numpy(float)).tolist())


def score_toxicity(documents: DataFrame, model: ToxicityModel, score: str = "score") -> DataFrame:
    """The columns of ``documents`` and ``score``: the probability of label 1 for the column ``text``.

    Null and empty texts and texts without a match get the base rate of such texts. Rows, repeated or with null
    ids, are kept one to one; only ``text`` is read.
    """
    schema = with_field(documents.schema, score, T.DoubleType())
    return documents.mapInArrow(_features(model.weights, model, "text", score), schema)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_toxicity(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted")
    )
