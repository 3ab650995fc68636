"""Document quality by Bradley-Terry ranking on features of the text.

The labels give preferences: a document of label 1 is preferred to one of label 0. The
chance that i is preferred to j is the logistic function of s(i) - s(j), where s is linear in
a document's features, so the weights come from a logistic regression on differences of
features of preferred and other documents (each paired with several of the other label).
The threshold is a quantile of the scores of all labelled rows: as many are below it as have
label 0. Scores are mapped to 0..1 so that the threshold becomes PREDICTED.

Features are numbers that any text has: lengths, shares of kinds of characters, repeated
words, pairs and lines. They are computed in tasks over whole texts; the weights are fitted on
the driver from at most `sample` labelled rows of each label, those of the smallest hashes.

Null texts are empty; an empty text has a score too. Null ids are in no label table. Rows
without both labels in the sample give every document the score 0.5. Repeated rows are scored
each. Empty tables give no rows. Other columns are carried along; helper names start with
`_quality` and `_label`.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.labelled import PREDICTED, known, labelled, logistic, remainder, sampled, sigmoid
from millrace.llm.words import utf8

#: Labelled rows of each label that the weights are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Pairs per document of the rarer label.
PAIRS = 8
#: Of the approximate quantile of the labelled rows' scores: its rank is off by one in so many rows at most.
ACCURACY = 100_000

_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_UPPER, _LOWER, _DIGIT = (np.array([f(chr(b)) and b < 128 for b in range(256)]) for f in (str.isupper, str.islower, str.isdigit))


def _line_shares(lines: list[bytes]) -> list[float]:
    full = [line for line in lines if line.strip()]
    n = max(1, len(full))
    repeats = n - len(set(full)) if full else 0
    ended = sum(line.rstrip()[-1:] in (b".", b"!", b"?", b":", b";") for line in full)
    short = sum(len(line) < 30 for line in full)
    return [np.log1p(len(full)), repeats / n, ended / n, short / n, np.log1p(sum(map(len, full)) / n), (len(lines) - len(full)) / len(lines)]


def features(text: bytes) -> np.ndarray:
    """The numbers of one text: shares, their square roots, and logarithms of lengths."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    bytes_ = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    letters = max(1, int(bytes_[_UPPER].sum() + bytes_[_LOWER].sum()))
    counts = Counter(words)
    common = counts.most_common(3) if words else []
    pairs = Counter(zip(words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:])))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, np.int64)
    again = sum(a == b for a, b in zip(words, words[1:]))
    loud = sum(w.isupper() and len(w) > 1 for w in words)
    plain = sum(w.isalnum() for w in words)
    wide = len(text) - bytes_[:128].sum()
    shares = [
        1 - len(counts) / n, sum(c for _, c in common) / n, common[0][1] / n if common else 0.0,
        1 - len(pairs) / max(1, n - 1), 1 - triples / max(1, n - 2), again / n, loud / n, plain / n,
        bytes_[_UPPER].sum() / letters, bytes_[_DIGIT].sum() / size, wide / size, (bytes_[9:14].sum() + bytes_[32]) / size, bytes_[10] / size,
        (lengths > 20).mean(), (lengths == 1).mean(), (lengths <= 3).mean(), bytes_[_MARKS].sum() / size, bytes_[:9].sum() / size,
        text.count(b"http") / n, text.count(b"  ") / n, *(bytes_[_MARKS] / n),
    ]
    shares = np.array(shares, dtype=np.float64)
    rest = [np.log1p(len(words)), np.log1p(len(text)), np.log1p(lengths.mean()), np.log1p(lengths.std()), float(len(words) == 0), float(len(words) < 20)]
    lines = _line_shares(text.split(b"\n"))
    return np.concatenate([shares, np.sqrt(np.maximum(shares, 0)), rest, lines]).astype(np.float32)


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (self.raw(x) - self.threshold) + np.log(PREDICTED / (1 - PREDICTED)))


def fit(x: np.ndarray, label: np.ndarray, seed: int = 0) -> Ranking:
    """Weights from PAIRS preference pairs for every row of the commoner label; the threshold is still 0."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    rng = np.random.default_rng(seed)
    n = PAIRS * max(len(good), len(bad))
    i, j = rng.permutation(np.resize(good, n)), np.resize(bad, n)
    sign = np.where(np.arange(n) % 2, 1.0, -1.0).astype(np.float32)
    weights = logistic((z[i] - z[j]) * sign[:, None], (sign > 0).astype(np.float64), ridge=1.0 + n * 1e-4)
    raw = z @ weights
    slope = abs(logistic(np.stack([raw, np.ones_like(raw)], axis=1), label.astype(np.float64), ridge=1e-3, constant=True)[0])
    return Ranking(mean, scale, weights, 0.0, float(np.clip(slope, 0.05, 20)))


def quantile(rows: DataFrame, ranking: Ranking, share: float) -> float:
    """The score that `share` of the labelled rows are below, over all of them."""
    sent = rows.sparkSession.sparkContext.broadcast(ranking)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(0))
            raw = sent.value.raw(np.stack([features(t) for t in texts])) if texts else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.float64())], names=["raw"])

    scores = rows.select("_quality_text").mapInArrow(compute, "raw double")
    return scores.agg(F.percentile_approx("raw", F.lit(float(share)), F.lit(ACCURACY))).first()[0]


def _with_features(rows: DataFrame) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t).tobytes() for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], names=["_label", "x"])

    return rows.select("_label", "_quality_text").mapInArrow(compute, "_label int, x binary")


def quality_scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", divisor: int = 5, held: int = 0, sample: int = SAMPLE_ROWS, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or only its columns `keep`) with `held_out`, `score` and `predicted`.

    Labels are learned from ids whose crc32 modulo `divisor` is not `held`.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("held_out", "score", "predicted")]
    known_ = known(labels, id, label).where(remainder(F.col("_label_id"), divisor) != held)
    counts = {r[0]: r[1] for r in known_.groupBy("_label").count().collect()}
    ranking = None
    if len(counts) == 2:
        rows = docs.select(F.col(f"`{id}`").alias("_label_id"), F.col(f"`{text}`").alias("_quality_text"))
        table = _with_features(labelled(rows, sampled(known_, sample))).toArrow()
        y = table.column("_label").to_numpy()
        if len(np.unique(y)) == 2:
            x = np.stack([np.frombuffer(b, np.float32) for b in table.column("x").to_pylist()])
            ranking = fit(x, y)
            ranking = replace(ranking, threshold=quantile(labelled(rows, known_), ranking, counts[0] / (counts[0] + counts[1])))
    sent = docs.sparkSession.sparkContext.broadcast(ranking)
    body = text if text in kept else "_quality_text"
    chosen = docs.select(
        *[F.col(f"`{c}`") for c in kept], *([] if body == text else [F.col(f"`{text}`").alias(body)]), (remainder(F.col(f"`{id}`"), divisor) == held).alias("held_out")
    )
    schema = StructType([f for f in chosen.schema.fields if f.name != "_quality_text"]).add("score", "double").add("predicted", "integer")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = utf8(batch.column(body))
            score = np.full(len(texts), 0.5)
            if model is not None and texts:
                score = model.score(np.stack([features(t) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in (*kept, "held_out")], pa.array(score), pa.array((score >= PREDICTED).astype(np.int32))], names=schema.names
            )

    return chosen.mapInArrow(scored, schema)
