"""Toxicity scores by a factorization machine over hashed terms.

Terms of a document are its distinct lower-case words and the first four, five and six
letters of longer ones, hashed to 2**24 numbers. Those that tell the classes of the
training sample apart (a likelihood-ratio test on document counts, taken over the sample
by a Spark aggregate) become the columns of the machine; all others have weight zero.
The machine scores sum(w_i) + sum over pairs of <v_i, v_j>, so two terms that are harmless
alone (a group's name, a mild insult) can weigh heavily together. Weights come from
full-batch Adam on the logistic loss with ridge penalties.

Only the text is an input. Null and empty texts have no terms and get the score of the
intercept. Without labels, or with labels of one class, every document gets the smoothed
share of toxic labels.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import cut, texts
from ledgerflow.llm.labelled import held_out, training_rows

SAMPLE = 8000
COLUMNS = 768
SPACE = (1 << 24) - 1
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")
CACHE = 500_000


def word_terms(word: str) -> list[int]:
    """Hashed terms of one lower-case word."""
    out = [zlib.crc32(f"w {word}".encode()) & SPACE]
    out += [zlib.crc32(f"p {word[:k]}".encode()) & SPACE for k in (4, 5, 6) if len(word) >= k]
    return out


def terms(t: str) -> list[int]:
    return sorted({h for w in set(_WORD.findall(t.lower())) for h in word_terms(w)})


@dataclass
class Machine:
    columns: dict[int, int]
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, active: list[np.ndarray]) -> np.ndarray:
        """Scores of documents given by their column numbers."""
        raw = np.full(len(active), self.bias)
        for k, a in enumerate(active):
            if len(a):
                v = self.factors[a]
                raw[k] += self.linear[a].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum())
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


class Columns:
    """Column numbers of a text's terms, words looked up in a bounded cache."""

    def __init__(self, columns: dict[int, int]):
        self.columns, self.words = columns, {}

    def _word(self, w: str) -> tuple[int, ...]:
        got = tuple([self.columns[h] for h in word_terms(w) if h in self.columns])
        if len(self.words) < CACHE:
            self.words[w] = got
        return got

    def of(self, t: str) -> np.ndarray:
        have, out = self.words, set()
        for w in set(_WORD.findall(t.lower())):
            got = have.get(w)
            out.update(self._word(w) if got is None else got)
        return np.fromiter(sorted(out), np.int64, len(out))


def fit(active: list[np.ndarray], y: np.ndarray, columns: dict[int, int], rank: int = 6, steps: int = 400,
        rate: float = 0.05, ridge: float = 2e-5, ridge_factors: float = 5e-3, seed: int = 11) -> Machine:
    """Full-batch Adam on the mean logistic loss; the ridge on the factors is the stronger one, so
    a single telling term scores by its own weight and pairs add what it lacks."""
    n, m = len(active), len(columns)
    share = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    par = [np.array([start]), np.zeros(m), rng.normal(0, 0.05, (m, rank))]
    if n == 0 or m == 0 or y.min() == y.max():
        return Machine(columns, start, np.zeros(m), np.zeros((m, rank)))
    # documents with the same columns and label are one weighted row
    same: dict[tuple[bytes, float], int] = {}
    for a, label in zip(active, y.tolist()):
        same[a.tobytes(), label] = same.get((a.tobytes(), label), 0) + 1
    x = np.zeros((len(same), m), np.float32)
    for k, (a, _) in enumerate(same):
        x[k, np.frombuffer(a, np.int64)] = 1
    y, weight = np.array([label for _, label in same], np.float32), np.array([*same.values()], np.float32)
    weight *= np.where(y == 1, np.sqrt((n - share * n) / (share * n)), 1)  # the rarer class counts for more
    weight = (weight / weight.sum()).astype(np.float32)
    par = [p.astype(np.float32) for p in par]
    first, second = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    for step in range(1, steps + 1):
        b, w, v = par
        q = x @ v
        raw = b[0] + x @ w + 0.5 * ((q * q).sum(axis=1) - x @ (v * v).sum(axis=1))
        g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) * weight
        xg = x.T @ g
        grads = [np.array([g.sum()]), xg + ridge * w, x.T @ (q * g[:, None]) - v * xg[:, None] + ridge_factors * v]
        for k, d in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * d
            second[k] = 0.999 * second[k] + 0.001 * d * d
            par[k] = par[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Machine(columns, float(par[0][0]), par[1], par[2])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on a bounded sample. What comes to the driver: at most ``COLUMNS`` terms, and for
    each sampled document which of them it has."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [terms(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(found, pa.list_(pa.int32()))],
                                             ["doc_id", "y", "terms"])

    rows = cut(training_rows(docs, labels, "toxic", sample).mapInArrow(hashed, "doc_id long, y int, terms array<int>"),
               "toxic-sample")
    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    seen = (rows.select("y", F.explode("terms").alias("term")).groupBy("term")
            .agg(F.count("*").cast("double").alias("a"), F.sum("y").cast("double").alias("a1")).where("a >= 4"))
    share = n1 / n if n else 0.0
    expect = F.col("a") * share

    def part(seen_, expected):
        return F.when(seen_ > 0, seen_ * F.log(seen_ / expected)).otherwise(0.0)

    if 0 < n1 < n:
        gain = part(F.col("a1"), expect) + part(F.col("a") - F.col("a1"), F.col("a") - expect)
        best = seen.select("term", gain.alias("gain")).where("gain > 6").orderBy(F.desc("gain"), "term").limit(COLUMNS)
        columns = {r.term: k for k, r in enumerate(best.collect())}
    else:
        columns = {}
    wanted = F.array(*[F.lit(c) for c in columns]) if columns else F.array().cast("array<int>")
    got = rows.select("doc_id", "y", F.array_intersect("terms", wanted).alias("has")).toPandas()
    got = got.sort_values("doc_id", kind="stable")
    active = [np.array(sorted(columns[h] for h in has), np.int64) for has in got["has"]]
    return fit(active, got["y"].to_numpy(float), columns)


def score_documents(docs: DataFrame, model: Machine) -> DataFrame:
    """(doc_id, score, predicted) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Columns(model.columns)
        for b in batches:
            s = model.score([find.of(t) for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score, learnt from the labels that are not held out."""
    out = score_documents(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
