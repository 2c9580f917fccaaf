"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its features. Training pairs set a document
labelled good against one labelled bad; the chance that the good one wins is the logistic
function of the difference of their strengths, so the weights come from a logistic
regression (Newton steps, ridge penalty) on differences of feature vectors, without an
intercept. Every document of the larger class is paired ``rounds`` times with partners of
the other class in a fixed shuffled order. The acceptance threshold is a quantile of the
training strengths: the one that rejects the share of documents labelled bad. Scores are
the logistic function of the strength above the threshold, so 0.5 is the threshold.

Only the text is an input. Null and empty texts get the features of an empty text, like
any other text. With labels of one class only, or none, nothing can be ranked: every
document then scores 1 (good) or 0 (bad), without labels 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import texts
from ledgerflow.llm.labelled import held_out, training_rows

SAMPLE = 6000
_LONG = re.compile(r"\S{30,}")


def features(t: str) -> list[float]:
    """Shares and rates that do not grow with the text's length, and their tails."""
    words = t.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    size = len(t)
    raw = np.frombuffer(t.encode(), np.uint8)
    kinds = np.bincount(raw, minlength=256)
    low = [w.lower() for w in words]
    distinct = len(set(low))
    letters = float(kinds[65:91].sum() + kinds[97:123].sum())
    upper = float(kinds[65:91].sum()) / max(1.0, letters)
    marks = float(kinds[[33, 63, 35, 36, 42, 37, 64, 38, 61, 124, 94, 126, 60, 62, 91, 93, 123, 125, 92, 47, 95]].sum()) / len(raw)
    digits = float(kinds[48:58].sum()) / len(raw)
    stops = float(kinds[46] + kinds[44]) / n
    p = kinds[kinds > 0] / len(raw)
    entropy = float(-(p * np.log2(p)).sum())
    lines = t.split("\n")
    lines_kept = len(set(lines)) / len(lines)
    pairs = len(set(zip(low, low[1:]))) / max(1, n - 1)
    same = sum(map(str.__eq__, low, low[1:])) / max(1, n - 1)
    heaps = distinct / n ** 0.8
    length = sum(map(len, words)) / n
    shouted = sum(map(str.isupper, words)) / n
    titled = sum(map(str.istitle, words)) / n
    short = sum([len(w) <= 3 for w in words]) / n
    odd = float(kinds[:9].sum() + kinds[11:32].sum() + kinds[127]) / len(raw)
    x = [upper, shouted, titled, marks, digits, stops, entropy, lines_kept, distinct / n, pairs, same, min(heaps, 2.0),
         length, short, odd, len(_LONG.findall(t)) / n, float(np.log1p(n)), n / len(lines), size / (n * 10)]
    return [*x, min(1.0, 20 * marks), min(1.0, 4 * upper), float(distinct / n < 0.4), float(pairs < 0.8),
            float(stops < 0.02), float(length > 7.5), float(length < 3.5), float(entropy < 3.8)]


N_FEATURES = 27


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        strength = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights
        return 1 / (1 + np.exp(-np.clip(strength - self.threshold, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 4, ridge: float = 3.0, seed: int = 7) -> Ranker:
    """Weights from preference pairs, threshold from the quantile of the training strengths."""
    width = x.shape[1] if x.ndim == 2 else N_FEATURES
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        level = 0.0 if not len(y) else (-40.0 if len(good) else 40.0)
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), level)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale < 1e-9, 1.0, scale)
    z = np.clip((x - mean) / scale, -6, 6)
    rng = np.random.default_rng(seed)
    n = max(len(good), len(bad))
    deal = lambda ids: np.concatenate([np.resize(rng.permutation(ids), n) for _ in range(rounds)])
    d = z[deal(good)] - z[deal(bad)]
    w = np.zeros(width)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -40, 40)))
        grad = d.T @ (1 - p) - ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(width)
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    # the quantile lies between two documents: take the middle of the gap
    order, k = np.sort(s), len(bad)
    return Ranker(mean, scale, w, float((order[k - 1] + order[k]) / 2))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranker:
    """Fit on a bounded sample; its features, ``N_FEATURES`` numbers a row, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "y", "x"])

    rows = (training_rows(docs, labels, "quality", sample)
            .mapInArrow(run, "doc_id long, y int, x array<double>").toPandas().sort_values("doc_id", kind="stable"))
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), N_FEATURES)
    return fit(x, rows["y"].to_numpy())


def score_documents(docs: DataFrame, model: Ranker) -> DataFrame:
    """(doc_id, score, predicted) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column("text").to_pylist()], float).reshape(b.num_rows, N_FEATURES)
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score, learnt from the labels that are not held out."""
    out = score_documents(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def accept(docs: DataFrame, model: Ranker) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least 0.5."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t or "") for t in b.column(place).to_pylist()], float).reshape(b.num_rows, N_FEATURES)
            yield b.filter(pa.array(model.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
