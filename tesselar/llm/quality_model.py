"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages; only the document has a label. Every passage is encoded, gated attention gives it
a weight, and the weighted sum of the encodings is classified. Encoder, attention and classifier are learned
together from document labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesselar.llm.grams import BASE, POWERS, mix
from tesselar.llm.training import held_out, labelled_sample, with_field

#: Labelled rows to fit on, at most; of each all passages are used.
SAMPLE = 6_000
PASSAGE_WORDS = 48
HIDDEN, GATE = 32, 16
EPOCHS, RATE, DECAY, BAGS = 30, 0.01, 1e-4, 128
PREDICT = 0.3

#: Byte -> class: each ASCII punctuation mark and white-space sign its own, lower case, upper case, digits, other
#: control bytes, first and later bytes of longer characters.
_MARKS = [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F), 0x09, 0x0A, 0x20]
BYTE_CLASS = np.full(256, 3, np.int64)
BYTE_CLASS[ord("a") : ord("z") + 1] = 0
BYTE_CLASS[ord("A") : ord("Z") + 1] = 1
BYTE_CLASS[ord("0") : ord("9") + 1] = 2
BYTE_CLASS[0x80:0xC0] = 4
BYTE_CLASS[0xC0:] = 5
BYTE_CLASS[_MARKS] = 6 + np.arange(len(_MARKS))
N_CLASSES = 6 + len(_MARKS)
#: Coarse classes for pairs of neighbours: lower, upper, digit, control, beyond ASCII, mark, blank, line feed.
COARSE = np.array([0, 1, 2, 3, 4, 4] + [5] * (len(_MARKS) - 3) + [6, 7, 6])
N_PAIRS = 64
N_FEATURES = N_CLASSES + N_PAIRS + 7
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def passage_features(text: str | None) -> np.ndarray:
    """One row per passage of ``PASSAGE_WORDS`` words; a text without words is one passage of zeros."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    white = _WHITE[raw]
    starts = np.flatnonzero(~white & np.concatenate([[True], white[:-1]])) if len(raw) else np.empty(0, int)
    if not len(starts):
        return np.zeros((1, N_FEATURES), np.float32)
    ends = np.flatnonzero(~white & np.concatenate([white[1:], [True]])) + 1
    n = -(-len(starts) // PASSAGE_WORDS)
    passage_of_word = np.arange(len(starts)) // PASSAGE_WORDS
    cuts = starts[::PASSAGE_WORDS].copy()
    cuts[0] = 0
    passage = np.repeat(np.arange(n), np.diff([*cuts, len(raw)]))
    kind = BYTE_CLASS[raw]
    size = np.bincount(passage, minlength=n)[:, None]
    singles = np.bincount(passage * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, N_CLASSES) / size
    coarse = COARSE[kind]
    pairs = np.bincount(passage[1:] * N_PAIRS + coarse[:-1] * 8 + coarse[1:], minlength=n * N_PAIRS).reshape(n, N_PAIRS) / size
    # Hashes of words and of word triples, to see what the text has said before.
    up, down = POWERS.to(len(raw) + 1)
    running = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=running[1:])
    word = mix((running[ends] - running[starts]) * down[starts])
    words = np.bincount(passage_of_word, minlength=n)

    def seen_before(values: np.ndarray) -> np.ndarray:
        repeated = np.ones(len(values), bool)
        repeated[np.unique(values, return_index=True)[1]] = False
        return np.bincount(passage_of_word[: len(values)], weights=repeated, minlength=n) / words

    base = np.uint64(BASE)
    triple = (word[:-2] * base + word[1:-1]) * base + word[2:] if len(word) > 2 else word[:0]
    in_passage = np.unique(np.stack([passage_of_word.astype(np.uint64), word]), axis=1)[0].astype(int)
    length = np.bincount(passage_of_word, weights=ends - starts, minlength=n) / words
    square = np.bincount(passage_of_word, weights=(ends - starts) ** 2.0, minlength=n) / words
    extra = [
        seen_before(word),
        seen_before(triple),
        np.bincount(in_passage, minlength=n) / words,
        length / 10,
        np.sqrt(np.maximum(square - length**2, 0)) / 10,
        words / PASSAGE_WORDS,
        np.full(n, np.log1p(len(starts)) / 5),
    ]
    return np.hstack([np.sqrt(singles), np.sqrt(pairs), np.stack(extra, axis=1)]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Parameters by name: ``mean``, ``scale``, encoder ``W b``, gates ``V U``, attention ``w``, classifier ``c d``."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Encodings, attention and logits of bags; bag i has the rows from ``starts[i]`` to the next start."""
        p = self.p
        counts = np.diff([*starts, len(x)])
        s = (x - p["mean"]) / p["scale"]
        h = np.tanh(s @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        a = e / np.repeat(np.add.reduceat(e, starts), counts)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"s": s, "h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ p["c"] + p["d"], "counts": counts}

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, starts)
        d_logit = (_sigmoid(f["logit"]) - y) / len(y)
        d_z = np.repeat(d_logit[:, None] * p["c"], f["counts"], axis=0)
        d_a = (d_z * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["a"] * d_a, starts), f["counts"])
        d_e = (f["a"] * (d_a - mean))[:, None]
        d_t = d_e * p["w"] * f["g"] * (1 - f["t"] ** 2)
        d_g = d_e * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        d_h = (f["a"][:, None] * d_z + d_t @ p["V"].T + d_g @ p["U"].T) * (1 - f["h"] ** 2)
        return {
            "W": f["s"].T @ d_h,
            "b": d_h.sum(axis=0),
            "V": f["h"].T @ d_t,
            "U": f["h"].T @ d_g,
            "w": (d_e * f["t"] * f["g"]).sum(axis=0),
            "c": f["z"].T @ d_logit,
            "d": d_logit.sum(),
        }


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 7) -> AttentionModel:
    """Adam on the log loss; without bags a model that scores everything alike."""
    rng = np.random.default_rng(seed)
    rows = np.concatenate(bags) if bags else np.zeros((1, N_FEATURES), np.float32)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    share = (y.sum() + 1) / (len(y) + 2)
    model = AttentionModel(
        {
            "mean": rows.mean(axis=0),
            "scale": rows.std(axis=0) + 0.02,
            "W": draw(N_FEATURES, HIDDEN),
            "b": np.zeros(HIDDEN, np.float32),
            "V": draw(HIDDEN, GATE),
            "U": draw(HIDDEN, GATE),
            "w": draw(GATE),
            "c": np.zeros(HIDDEN, np.float32),
            "d": np.float32(np.log(share / (1 - share))),
        }
    )
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items() if k not in ("mean", "scale")}
    step = 0
    for epoch in range(EPOCHS if bags else 0):
        order = rng.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS) + RATE / 50
        for first in range(0, len(order), BAGS):
            chosen = order[first : first + BAGS]
            x = np.concatenate([bags[i] for i in chosen])
            starts = np.cumsum([0, *[len(bags[i]) for i in chosen[:-1]]])
            step += 1
            for k, g in model.gradients(x, starts, y[chosen]).items():
                g = g + DECAY * model.p[k]
                m, v = moments[k]
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                moments[k] = m, v
                model.p[k] = (model.p[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [passage_features(text).tobytes() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.binary())], ["label", "x"])


def fit_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionModel:
    """Learn from at most ``sample`` labelled rows outside the held-out fold."""
    rows = labelled_sample(documents, labels, "quality", sample)
    table = rows.select("label", "text").mapInArrow(_training_rows, "label int, x binary").toPandas()
    bags = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for x in table["x"]]
    order = np.array(sorted(range(len(bags)), key=lambda i: (len(bags[i]), table["x"][i])), int)  # any row order gives this model
    return fit([bags[i] for i in order], table["label"].to_numpy(float)[order])


def _scores(parameters: dict[str, np.ndarray], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = AttentionModel(parameters)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            bags, first, rows = [], 0, 0
            for at, text in enumerate(batch.column("text").to_pylist()):
                bags.append(passage_features(text))
                rows += len(bags[-1])
                if rows >= 4096 or at + 1 == batch.num_rows:  # a bounded number of passages at a time
                    starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
                    scores[first : at + 1] = _sigmoid(model.forward(np.concatenate(bags), starts)["logit"])
                    bags, first, rows = [], at + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, name])

    return run


def score_quality(documents: DataFrame, model: AttentionModel, score: str = "score") -> DataFrame:
    """The columns of ``documents`` and ``score``: the probability of label 1 for the column ``text``.

    Null, empty and blank texts are one passage of zeros and all get the same score. Rows, repeated or with null
    ids, are kept one to one; only ``text`` is read.
    """
    return documents.mapInArrow(_scores(model.p, score), with_field(documents.schema, score, T.DoubleType()))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted")
    )
