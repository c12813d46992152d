"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k | text) = 1 / (1 + exp(w.x - threshold_k)): one weight vector over
hashed text features, shared by all grades, and ordered thresholds. It gives
the expected grade and, for selection, the tail probability P(grade >= k).

Features are relative frequencies of hashed byte n-grams (``hashed_text``), so
a text scores as the mean weight of its n-grams: one table lookup a byte.

The fit uses at most ``MAX_RATED`` rated texts (those with the smallest XXH64 of
their doc_id), a documented bound; their features, not their texts, come to
the driver. Scoring covers every text whole.

Defined results
* null or empty text: w.x = 0, the thresholds alone decide;
* several ratings of one document: their lowest counts; a grade that is null or
  out of range is ignored; without ratings of two grades, every probability is
  that of the rated share (of grade 0 if there are none);
* repeated rows give repeated rows, and one text of each doc_id (that with the
  smallest XXH64) takes part in the fit; an empty table gives an empty table;
  other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids_and_text, one_text_each, raw_bytes
from .hashed_text import frequencies, scores

MAX_RATED = 6_000
QUALITY_DIM = 1 << 12
STEPS = 150
RIDGE = 1e-4


@dataclass
class OrdinalModel:
    weights: np.ndarray      # by bucket
    thresholds: np.ndarray   # ascending, one fewer than grades

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, a row for each x = w.x."""
        return 1 / (1 + np.exp(-np.clip(np.asarray(x)[:, None] - self.thresholds[None, :], -500, 500)))


def rated_features(docs: DataFrame, ratings: DataFrame, grades: int, limit: int) -> tuple[list, np.ndarray]:
    """Features and grades of at most ``limit`` rated texts."""
    known = (ratings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade"))
             .where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1))
             .groupBy("doc_id").agg(F.min("grade").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [frequencies(t.as_py(), QUALITY_DIM) for t in raw_bytes(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["grade"], pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rows], pa.list_(pa.float32()))], ["doc_id", "grade", "at", "f"])

    # ``known`` has at most ``limit`` rows of 12 bytes, and one text each stays
    got = (one_text_each(docs.join(F.broadcast(known), "doc_id"), "grade").select("doc_id", "text", "grade")
           .mapInArrow(run, "doc_id long, grade int, at array<int>, f array<float>").toArrow())
    got = got.take(np.argsort(got["doc_id"].to_numpy(), kind="stable"))
    feats = [(a.values.to_numpy(), f.values.to_numpy()) for a, f in zip(got["at"], got["f"])]
    return feats, got["grade"].to_numpy()


def fit_ordinal(feats: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, grades: int) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam over the whole sample as one
    dense matrix (MAX_RATED x QUALITY_DIM at most).

    Thresholds stay ordered: they are a first one plus positive steps."""
    share = np.array([(y >= k).mean() if len(y) else 0.0 for k in range(1, grades)])
    start = -np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6)))
    start = np.maximum.accumulate(start + 1e-3 * np.arange(grades - 1))
    if len(set(y.tolist())) < 2:
        return OrdinalModel(np.zeros(QUALITY_DIM, np.float32), start)
    x = np.zeros((len(feats), QUALITY_DIM), np.float32)
    for i, (at, f) in enumerate(feats):
        x[i, at] = f
    # a feature counts by its spread over the sample, so rare marks are heard
    scale = 1 / np.sqrt(np.einsum("ij,ij->j", x, x) / len(x) + 1e-9)
    x *= scale
    norm = np.sqrt(np.einsum("ij,ij->i", x, x)).mean()
    x /= norm
    d = QUALITY_DIM
    theta = np.concatenate([np.zeros(d), [start[0]], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, STEPS + 1):
        cuts = theta[d] + np.concatenate([[0.0], np.cumsum(np.exp(theta[d + 1:]))])
        z = (x @ theta[:d].astype(np.float32)).astype(np.float64)
        edge = np.concatenate([[-1e9], cuts, [1e9]])
        up, low = sigmoid(edge[y + 1] - z), sigmoid(edge[y] - z)
        p = np.maximum(up - low, 1e-9)
        du, dl = up * (1 - up) / p, low * (1 - low) / p
        gz = (du - dl) / len(x)                      # of -log p by z
        gc = np.zeros(grades + 1)
        np.add.at(gc, y + 1, -du / len(x))
        np.add.at(gc, y, dl / len(x))
        gc = gc[1:-1]
        g = np.concatenate([gz.astype(np.float32) @ x + RIDGE * theta[:d], [gc.sum()],
                            np.exp(theta[d + 1:]) * np.array([gc[k:].sum() for k in range(1, grades - 1)])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return OrdinalModel((theta[:d] * scale / norm).astype(np.float32),
                        theta[d] + np.concatenate([[0.0], np.cumsum(np.exp(theta[d + 1:]))]))


def fit(docs: DataFrame, ratings: DataFrame, grades: int, doc_id: str = "doc_id", text: str = "text",
        limit: int = MAX_RATED) -> OrdinalModel:
    """``ratings``: (doc_id, grade from 0 to grades - 1)."""
    return fit_ordinal(*rated_features(ids_and_text(docs, doc_id, text), ratings, grades, limit), grades)


def score(docs: DataFrame, model: OrdinalModel, keep_grade: int = 1, keep_at: float = 0.5,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept): kept where
    P(grade >= keep_grade) reaches ``keep_at``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.weights[:, None]
        for batch in batches:
            x = np.array([scores(t.as_py(), table)[0] for t in raw_bytes(batch["text"])], np.float64)
            tails = model.tails(x)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(tails.sum(axis=1)), pa.array(tails[:, keep_grade - 1])],
                ["doc_id", "expected_grade", "tail_probability"])

    return (ids_and_text(docs, doc_id, text)
            .mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")
            .withColumn("kept", F.col("tail_probability") >= keep_at))
