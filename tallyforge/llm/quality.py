"""Operator 8: quality by a regularised quadratic discriminant over document statistics.

Each text becomes a few statistics (letter case, signs, repeated words), transformed to be nearer to normal.
Each class has a mean and a covariance shrunk towards a diagonal one; the score is the logistic of the difference of the two log
densities, by Mahalanobis distances that need only the cached Cholesky factors.

The fit sees the statistics of a sample of at most about `most` labelled documents outside the held-out fold; scoring sees every
document, in Arrow batches, without a shuffle.

Defined cases: null and empty texts have the statistics of no words and are scored as others; unusable labels count for nothing;
where either class has no labelled document, every score is the share of label 1 (0.5 without any label); repeated rows give
repeated rows; other columns of the tables are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WORD_BYTES, labelled_sample
from .shared import fold as fold_of

THRESHOLD = 0.7
MOST_LABELLED = 12_000
SHRINK = 0.1  # weight of the diagonal in a class covariance
FLOOR = 0.5  # least standard deviation of a statistic, in those of all labelled documents together

FEW = 10  # words added to a text's where shares of words are taken, so that short texts are not far out

UPPER, SIGN = bytes(range(65, 91)), b"#$%&*+/<=>@[\\]^_`{|}~"
NAMES = ["capitals", "signs", "exclamations", "bars", "distinct words", "words as the last", "most common word"]


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text, in the order of NAMES: roots of shares, and a log for distinct words."""
    raw = (text or "").encode()
    n = max(1, len(raw))
    words = raw.translate(WORD_BYTES).split()
    share = lambda drop: math.sqrt((len(raw) - len(raw.translate(None, drop))) / n)
    common = Counter(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [
        share(UPPER),
        share(SIGN),
        share(b"!"),
        share(b"|"),
        math.log((len(common) + FEW) / (len(words) + FEW)),
        math.sqrt(same / (len(words) + 2 * FEW)),
        math.sqrt(max(common.values(), default=0) / (len(words) + 2 * FEW)),
    ]


@dataclass
class Discriminant:
    """Means and Cholesky factors of the two classes over centred and scaled statistics, kept as factors of their inverses."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    inverse: list[np.ndarray]  # of the Cholesky factors
    constant: list[float]  # log prior less half the log determinant
    only: float | None = None  # the score of all, where there is nothing to tell apart

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, shrink: float = SHRINK) -> Discriminant:
        if not len(y) or y.min() == y.max():
            return cls(np.zeros(0), np.ones(0), [], [], [], float(y.mean()) if len(y) else 0.5)
        centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = (x - centre) / scale
        means, inverse, constant = [], [], []
        for k in (0, 1):
            own = z[y == k]
            s = np.cov(own.T, bias=True) if len(own) > 1 else np.eye(z.shape[1])
            s = (1 - shrink) * s + shrink * np.diag(np.diag(s)) + FLOOR**2 * np.eye(len(s))
            factor = np.linalg.cholesky(s)
            means.append(own.mean(0))
            inverse.append(np.linalg.inv(factor))
            constant.append(math.log(len(own) / len(z)) - float(np.log(np.diag(factor)).sum()))
        return cls(centre, scale, means, inverse, constant)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), self.only)
        z = (x - self.centre) / self.scale
        logs = [c - 0.5 * (((z - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.inverse, self.constant, strict=True)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -40, 40)))


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Discriminant:
    """A discriminant from the labels outside the held-out fold; a row of statistics a sampled document comes to the driver."""
    sample = labelled_sample(docs, labels, "quality", most)

    def measured(batches):
        for batch in batches:
            rows = [statistics(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    rows = sample.select("text", "label").mapInArrow(measured, "x array<double>, y int").collect()
    return Discriminant.fit(np.array([r["x"] for r in rows]).reshape(len(rows), len(NAMES)), np.array([r["y"] for r in rows]))


def scorer(spark, model: Discriminant):
    held = spark.sparkContext.broadcast(model)  # two matrices of 7 x 7

    def scores(texts: pa.Array) -> pa.Array:
        rows = [statistics(t) for t in texts.to_pylist()]
        return pa.array(held.value.scores(np.array(rows).reshape(len(rows), len(NAMES))), pa.float64())

    return F.arrow_udf(scores, "double")


def score_documents(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    score = scorer(docs.sparkSession, learn(docs, labels, most))
    rows = docs.select("doc_id", F.coalesce(fold_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"), score(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """docs predicted to be of good quality, with their own columns; all of them where the labels tell nothing apart."""
    model = learn(docs, labels, most)
    return docs if model.only is not None else docs.where(scorer(docs.sparkSession, model)(F.col("text")) >= THRESHOLD)
