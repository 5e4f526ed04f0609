"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Grades are ordered: 0 clean, 1 toxic, 2 toxic and of low quality. The model has one
weight vector and one threshold per step of the scale, ``P(grade > k) = s(w.x - t_k)``
with ``t_0 <= t_1``, so all steps share the weights; the expected severity is the sum of
these probabilities. Features are the distinct lower-cased words of the whole text,
hashed to ``2**FEATURE_BITS`` places; those that stand out in toxic rows are kept.

Fitted on about ``TRAIN_ROWS`` labelled rows per class at most (a documented bound;
chosen by a hash of the id), with an L1 penalty so that only telling words keep a weight. Scoring
is one narrow pass over all documents with the sparse weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import ship_by_value
from .common import append_columns
from .decontaminate import Words

ship_by_value(__name__)

FEATURE_BITS = 20
TRAIN_ROWS = 8000
ROUNDS = 300
L1 = 1e-4
L2 = 1e-5
MIN_ROWS = 3
MIN_Z = 3.0


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted feature places with a weight
    weights: np.ndarray
    thresholds: np.ndarray  # one per step of the scale


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature places of one text."""
    if not text:
        return np.zeros(0, np.int64)
    h = Words(text.lower().encode("utf-8", "surrogatepass")).hash
    return np.unique(h & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(docs: DataFrame, grades: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the texts of a bounded hash sample of ``grades (id, grade)``; NULL ids and
    grades are left out. Without rows, or with one grade only, the model answers that
    grade for any text. The sample (ids and grades) is small enough to be broadcast, so
    the texts stay where they are."""
    src = grades.select(F.col(id_col).alias("id"), F.col("grade").cast("int").alias("grade")).dropna()
    toxic = F.col("grade") > 0
    n = src.agg(F.count_if(toxic).alias("bad"), F.count_if(~toxic).alias("good")).first()
    u = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    part = F.when(toxic, F.lit(train_rows / max(n["bad"], 1))).otherwise(F.lit(train_rows / max(n["good"], 1)))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(src.where(u < part)), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs = [features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(xs, pa.list_(pa.int64()))], ["grade", "x"])

    # about 2 * train_rows rows of hashed words, whatever the input
    got = sample.select("text", "grade").mapInArrow(run, "grade int, x array<long>").toArrow()
    grade = got["grade"].to_numpy().astype(np.int64)
    x = got["x"].combine_chunks()
    if not len(grade):
        return Model(np.zeros(0, np.int64), np.zeros(0), np.array([40.0, 40.0]))
    row = np.repeat(np.arange(len(grade)), x.value_lengths().to_numpy())
    place = x.values.to_numpy() if len(row) else np.zeros(0, np.int64)
    names, col = np.unique(place, return_inverse=True)
    telling = _telling(row, col, grade > 0, len(names))
    new = np.cumsum(telling) - 1
    live = telling[col]
    names, row, col = names[telling], row[live], new[col[live]]
    weights, thresholds = _train(row, col, grade, len(names), int(grade.max()) + 1 if grade.max() > 0 else 2)
    on = weights != 0
    return Model(names[on], weights[on], thresholds)


def _telling(row: np.ndarray, col: np.ndarray, toxic: np.ndarray, n_features: int) -> np.ndarray:
    """Features whose share of toxic rows stands ``MIN_Z`` standard errors above the share of all rows."""
    df = np.bincount(col, minlength=n_features)
    bad = np.bincount(col, weights=toxic[row].astype(float), minlength=n_features)
    rate = min(max(toxic.mean(), 1e-6), 1 - 1e-6)
    z = (bad - df * rate) / np.sqrt(np.maximum(df, 1) * rate * (1 - rate))
    return (df >= MIN_ROWS) & (z >= MIN_Z)


def _train(row: np.ndarray, col: np.ndarray, grade: np.ndarray, n_features: int, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal steps with soft thresholding on the mean cumulative-link loss. A row's
    curvature counts once for each of its features, which bounds the joint step."""
    steps, n = n_grades - 1, len(grade)
    above = grade[:, None] > np.arange(steps)  # [row, step]
    rate = np.clip(above.mean(0), 1e-4, 1 - 1e-4)
    t = -np.log(rate / (1 - rate))
    w, active = np.zeros(n_features), np.bincount(row, minlength=n) + 1.0
    for _ in range(ROUNDS):
        z = np.bincount(row, weights=w[col], minlength=n)
        p = _sigmoid(z[:, None] - t)
        err = (p - above).sum(1)  # derivative by the score
        curve = np.maximum((p * (1 - p)).sum(1), 0.02) * active
        g = np.bincount(col, weights=err[row], minlength=n_features) / n
        h = np.bincount(col, weights=curve[row], minlength=n_features) / n + L2
        w = w - (g + L2 * w) / h
        w = np.sign(w) * np.maximum(np.abs(w) - L1 / h, 0)
        t = np.maximum.accumulate(t + 0.5 * (p - above).mean(0) / ((p * (1 - p) * active[:, None]).mean(0) + 1e-6))
    return w, t


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``severity`` (expected grade), ``p_toxic`` (P(grade > 0)), ``grade``
    (the number of steps more likely passed than not) and ``toxic`` (grade > 0); columns
    with those names are replaced. NULL and empty texts have no features and get the
    model's base rate; whole texts are read; repeated rows give equal results."""

    def run(text: pa.Array) -> list[pa.Array]:
        z = np.zeros(len(text))
        for i, t in enumerate(text.to_pylist()):
            x = features(t)
            if len(x) and len(model.features):
                at = np.minimum(np.searchsorted(model.features, x), len(model.features) - 1)
                z[i] = model.weights[at][model.features[at] == x].sum()
        p = _sigmoid(z[:, None] - model.thresholds)
        grade = (p > 0.5).sum(1)
        return [pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(grade.astype(np.int32)), pa.array(grade > 0)]

    fields = [T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("grade", T.IntegerType()), T.StructField("toxic", T.BooleanType())]
    return append_columns(docs, [text_col], fields, run)


def graded(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)`` of labelled documents: toxic, plus one more where quality is 0."""
    lab = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("__t"), F.min("quality").alias("__q"))
    return lab.select("doc_id", F.when(F.col("__t") > 0, F.when(F.col("__q") == 0, 2).otherwise(1)).otherwise(0).alias("grade"))
