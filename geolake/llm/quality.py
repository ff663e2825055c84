"""Quality from positives and unlabelled text: non-negative unbiased risk.

Trusted positives are texts labelled good; all other text is unlabelled, bad labels are never used. The risk on bad
text is that on unlabelled text less the share of good text in it, and is kept from falling below zero
(where a flexible model would only learn the sample). The share, the class prior, is estimated first: among typical good texts
the density of good over that of unlabelled text is one over the prior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import held_out, labelled, with_texts
from .shared import stored

#: Rows that a model is fitted on: positives and unlabelled texts, chosen by hash.
POSITIVES, UNLABELLED = 8_000, 12_000
THRESHOLD = 0.7


def features(data: bytes) -> np.ndarray:
    """Shares of characters and shapes of words and lines; of nothing but the text."""
    raw = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    shares = np.sqrt(np.append(raw[:128], raw[128:].sum()) / max(len(data), 1))
    words, lines = data.split(), data.split(b"\n")
    n, distinct = max(len(words), 1), len(set(words))
    again = sum(a == b for a, b in zip(words, words[1:])) / n
    pairs = len(set(zip(words, words[1:]))) / max(len(words) - 1, 1) if len(words) > 1 else 1.0
    shape = [
        np.log1p(len(data)), np.log1p(len(words)), distinct / n, again, pairs, np.log1p(len(lines)), len(set(lines)) / len(lines),
        sum(map(len, words)) / n / 10, sum(map(bytes.isupper, words)) / n, sum(map(bytes.isalpha, words)) / n, sum(map(bytes.isdigit, words)) / n,
        np.sqrt(again), np.sqrt(max(0.0, 1 - pairs)), float(len(words) < 20), float(not words),
    ]
    return np.concatenate([shares, shape]).astype(np.float32)


WIDTH = len(features(b""))


def _with_features(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``columns`` with an array of features of their text (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.stack([features(t) for t in batch.column(batch.num_columns - 1).to_pylist()]) if batch.num_rows else np.empty((0, WIDTH), np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * WIDTH, type=pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "features"])

    kept = rows.select(*columns, F.col("text").cast("binary").alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema[:-1])
    return kept.mapInArrow(run, f"{schema}, features array<float>")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(gradient, width: int, steps: int = 400, rate: float = 0.05) -> np.ndarray:
    """Adam on a full-batch gradient."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of good texts among the unlabelled ones, from the density ratio at typical positives.

    One half of both samples fits the ratio, the other reads it.
    """
    x = np.vstack([positive[::2], unlabelled[::2]])
    s = np.concatenate([np.ones(len(positive[::2])), np.zeros(len(unlabelled[::2]))])
    weight = np.where(s == 1, 0.5 / max(s.sum(), 1), 0.5 / max((1 - s).sum(), 1))
    w = _descend(lambda w: x.T @ (weight * (_sigmoid(x @ w) - s)) + 1e-3 * w, x.shape[1], 200)
    at = positive[1::2] if len(positive) > 1 else positive
    p = _sigmoid(at @ w)
    ratio = float(np.median(p / (1 - p)))
    return min(max(1 / max(ratio, 1e-6), 0.05), 0.98)


def nn_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a linear score that minimise the non-negative unbiased risk with logistic loss."""

    def gradient(w: np.ndarray) -> np.ndarray:
        p, u = _sigmoid(positive @ w), _sigmoid(unlabelled @ w)
        good = -prior * (positive.T @ (1 - p)) / len(positive)
        bad = (unlabelled.T @ u) / len(unlabelled) - prior * (positive.T @ p) / len(positive)
        risk = np.log1p(np.exp(np.clip(unlabelled @ w, -30, 30))).mean() - prior * np.log1p(np.exp(np.clip(positive @ w, -30, 30))).mean()
        # Below zero the estimate has learnt the sample: step back from it.
        return (good + bad if risk >= 0 else -bad) + ridge * w

    return _descend(gradient, positive.shape[1])


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> dict[str, np.ndarray]:
    """Fitted on at most so many positives (learning rows labelled 1) and unlabelled texts (learning rows, labels unread).

    Without positives or texts the score is 0.5 everywhere.
    """
    good = labelled(labels.filter("quality = 1"), "quality", positives).select("doc_id", F.lit(1).alias("good"))
    others = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    others = others.orderBy(F.xxhash64("doc_id", F.lit("unlabelled")), "doc_id").limit(unlabelled).select("doc_id", F.lit(0).alias("good"))
    texts = with_texts(docs, stored(good.unionByName(others), "sample"))
    table = _with_features(texts.select("good", "text"), ["good"]).toArrow()
    x = table.column("features").combine_chunks().flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
    good = table.column("good").to_numpy()
    p, u = x[good == 1], x[good == 0]
    if not len(p) or not len(u):
        return {"mean": np.zeros(WIDTH), "scale": np.ones(WIDTH), "weights": np.zeros(WIDTH + 1), "prior": np.array(0.5)}
    mean, scale = u.mean(axis=0), u.std(axis=0) + 1e-3
    fit = lambda rows: np.column_stack([np.ones(len(rows)), np.clip((rows - mean) / scale, -6, 6)])
    p, u = fit(p), fit(u)
    prior = class_prior(p, u)
    return {"mean": mean, "scale": scale, "weights": nn_pu(p, u, prior), "prior": np.array(prior)}


def with_scores(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """doc_id and score, 0 to 1, of each whole text; null texts are empty, repeated rows are scored each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([features(t) for t in batch.column(1).to_pylist()]) if batch.num_rows else np.empty((0, WIDTH))
            x = np.clip((x - model["mean"]) / model["scale"], -6, 6)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_sigmoid(model["weights"][0] + x @ model["weights"][1:]))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
