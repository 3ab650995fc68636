"""What the two classifiers share: labelled rows, and fitting a few weights on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.joins import join_keyed
from millrace.session import written

#: The score from which a document is predicted to have label 1.
PREDICTED = 0.3


def remainder(id: Column, divisor: int) -> Column:
    """crc32 of the id's text, modulo `divisor`; a null id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def known(labels: DataFrame, id: str, label: str) -> DataFrame:
    """(_label_id, _label): one row per id; null and unlike labels of an id say nothing."""
    rows = labels.select(F.col(f"`{id}`").alias("_label_id"), F.col(f"`{label}`").cast("int").alias("_label"))
    rows = rows.where("_label IN (0, 1) AND _label_id IS NOT NULL").groupBy("_label_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most"))
    return written(rows.where("_label = _most").drop("_most"), "labels")


def labelled(docs: DataFrame, labels: DataFrame, id: str = "_label_id") -> DataFrame:
    return join_keyed(docs, labels, [id], "inner")


def sampled(labels: DataFrame, rows: int) -> DataFrame:
    """At most `rows` labelled ids of each label, those of the smallest hashes."""
    parts = [labels.where(F.col("_label") == one).orderBy(F.xxhash64("_label_id"), "_label_id").limit(rows) for one in (0, 1)]
    return written(parts[0].union(parts[1]), "label_sample")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def logistic(features: np.ndarray, label: np.ndarray, ridge: float = 1.0, steps: int = 25, constant: bool = False) -> np.ndarray:
    """Weights of a logistic model, by Newton steps over chunks of rows.

    If the last feature is the `constant` one, its weight is left free: with few rows the
    model then tends to the share of label 1.
    """
    weights = np.zeros(features.shape[1])
    penalty = np.full(len(weights), float(ridge))
    if constant:
        penalty[-1] = 1e-6
    for _ in range(steps):
        gradient, hessian = -penalty * weights, np.diag(penalty)
        for at in range(0, len(features), 1 << 14):
            x, y = features[at : at + (1 << 14)].astype(np.float64), label[at : at + (1 << 14)]
            p = sigmoid(x @ weights)
            gradient += x.T @ (y - p)
            hessian += (x * (p * (1 - p))[:, None]).T @ x
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return weights
