"""Whitening of embeddings by refined eigenvectors of their covariance.

Two passes over the vectors sum up what the covariance needs: first the entries, then, centred
at the rounded means, their products. Entries are integers, so both sums are exact; a task adds
up its own rows and sends one number per pair of dimensions, and Spark adds these. The driver
sees those sums, whose number depends on the dimensions alone.

The eigenvectors start as LAPACK's in single precision. Ogita and Aishima's iteration then
corrects them by matrix products in extended precision (numpy's longdouble): with

    R = I - X'X,    S = X'VX,    l_i = S_ii / (1 - R_ii)
    E_ij = (S_ij + l_j R_ij) / (l_j - l_i)     X <- X + XE

the error is about squared in every step. Within a cluster, eigenvalues closer than what the
present error can tell apart, E_ij is R_ij / 2, which only makes the vectors orthonormal; the
cluster is solved by itself: V, projected on it and shifted by its mean, has small entries, so
that solving it in double precision tells apart eigenvalues far closer than before.

A third pass measures the covariance of the whitened vectors over all rows.

Rows whose vector is null, empty, or holds null or non-finite entries are left out; null and
repeated ids are rows like others. Vectors of unlike lengths share no covariance: each length is
a fit list of its own. Entries beyond 2**40 after scaling are held at that. Components without
variance (fewer distinct rows than dimensions) have null whitened values, and a deviation
beyond the range of a long is null. Empty tables give no rows; names of other columns do not
matter, as only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.vectors import usable

HIGH = np.longdouble
#: Scaled entries are held within this, so that all sums fit a decimal of 38 digits.
MOST = 2.0**40
#: Eigenvalues below this share of the trace are no variance but rounding.
NOTHING = 1e-16
ROUNDS = 60
_EXACT = 2.0**53
_TOTAL = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """What rows of one length are whitened by; `shift` is the rounded mean, `rest` n times what that leaves."""

    n: int
    shift: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole numbers on the components, each with variance 1 (nan: without variance)."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = self.vectors / np.sqrt(self.values)
        scaled[:, self.values <= 0] = np.nan
        return (x - self.shift - self.rest.astype(np.float64) / self.n) @ scaled

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - S) ** 2."""
        y = (x - self.shift).astype(np.int64)
        most = int(np.abs(y).max(initial=0)) * self.n + max(map(abs, self.rest.tolist()))
        if most * most * y.shape[1] < 1 << 62:
            off = self.n * y - self.rest.astype(np.int64)
            return (off * off).sum(axis=1).tolist()
        off = self.n * y.astype(object) - self.rest
        return [t if t < 1 << 63 else None for t in (off * off).sum(axis=1)]


def spectral(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision."""
    size, high = len(v), v.astype(HIGH)
    scale = np.abs(high).max(initial=0)
    if not scale:
        return np.zeros(size, HIGH), np.eye(size, dtype=HIGH)
    high = high / scale
    eps = np.finfo(HIGH).eps
    norm = np.sqrt((high * high).sum())
    x = np.linalg.eigh(high.astype(np.float32))[1].astype(HIGH)
    one = np.eye(size, dtype=HIGH)
    values, last = np.zeros(size, HIGH), np.inf
    for _ in range(ROUNDS):
        r = one - x.T @ x
        s = x.T @ (high @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        error = np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum())
        if error <= 4 * size * eps * norm or (error < 256 * size * eps * norm and error >= last):
            break
        last = error
        # Below the second bound, differences of eigenvalues are rounding.
        label = _clusters(values, max(8 * error, 256 * size * eps * norm))
        same = label[None, :] == label[:, None]
        gap = np.where(same, 1, values[None, :] - values[:, None])
        x = _orthonormal(x + x @ np.where(same, r / 2, (s + values[None, :] * r) / gap))
        for k in np.flatnonzero(np.bincount(label) > 1):
            x[:, label == k] = _solved(high, x[:, label == k])
    order = np.argsort(-values, kind="stable")
    x = _orthonormal(x[:, order])
    return values[order] * scale, x / np.sqrt((x * x).sum(axis=0))


def _clusters(values: np.ndarray, near: float) -> np.ndarray:
    """A number for each eigenvalue, the same along those whose neighbours by size are at most `near` apart."""
    order = np.argsort(values)
    label = np.empty(len(values), dtype=np.int64)
    label[order] = np.cumsum(np.r_[0, np.diff(values[order]) > near])
    return label


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Columns that are nearly orthonormal, squarely nearer."""
    return x @ (3 * np.eye(x.shape[1], dtype=HIGH) - x.T @ x) / 2


def _solved(v: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Columns that span what `x` spans, as eigenvectors of `v` within it."""
    inner = x.T @ (v @ x)
    inner = inner - np.eye(len(inner), dtype=HIGH) * (np.trace(inner) / len(inner))
    size = np.abs(inner).max()
    if not size:
        return x
    inner = ((inner + inner.T) / (2 * size)).astype(np.float64)
    return x @ _orthonormal(np.linalg.eigh(inner)[1].astype(HIGH))


def _whole(vectors: np.ndarray, scale: float, offset: int) -> np.ndarray:
    return np.clip(np.floor(scale * vectors), -MOST, MOST) + offset


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, vectors) of a batch's rows of each length."""
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        here = np.flatnonzero(sizes == size)
        vectors = batch.column("v").take(pa.array(here)).flatten().to_numpy(zero_copy_only=False)
        yield int(size), here, vectors.astype(np.float64).reshape(len(here), size)


def _products(y: np.ndarray) -> np.ndarray:
    """y'y, exact: in floating point by runs of rows whose sums stay whole, else in Python's integers."""
    most = float(np.abs(y).max(initial=0)) ** 2
    if most * 64 > _EXACT:
        y = y.astype(np.int64).astype(object)
        return y.T @ y
    step, total = int(_EXACT // max(most, 1)), 0
    for at in range(0, len(y), step):
        part = y[at : at + step]
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _summed(rows: DataFrame, each, kind: pa.DataType, type: str) -> list:
    """(size, i, j, total) over all rows, for `each(size, vectors)`, a matrix of sums per batch."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, vectors in _by_size(batch):
                totals[size] = totals.get(size, 0) + each(size, vectors)
        for size, total in totals.items():
            i, j = np.indices(total.shape)
            whole = pa.array(total.ravel().tolist(), kind)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(total.size, size), pa.int32()), pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), whole], names=["size", "i", "j", "total"])

    found = rows.select("size", "v").mapInArrow(step, f"size int, i int, j int, total {type}")
    return found.groupBy("size", "i", "j").agg(F.sum("total").alias("total")).collect()


def _matrices(sums: list) -> dict[int, np.ndarray]:
    shapes: dict[int, tuple[int, int]] = {}
    for r in sums:
        a, b = shapes.get(r.size, (0, 0))
        shapes[r.size] = max(a, r.i + 1), max(b, r.j + 1)
    out = {size: np.zeros(shape, dtype=object) for size, shape in shapes.items()}
    for r in sums:
        out[r.size][r.i, r.j] = r.total
    return out


def _ready(rows: DataFrame, vector: str) -> tuple:
    v = F.col(f"`{vector}`")
    return v.alias("v"), F.size(v).alias("size"), usable(v) & (F.size(v) > 0)


def fit(rows: DataFrame, vector: str = "embedding", components: int = 32, scale: float = 64.0, offset: int = 1_000_000) -> dict[int, Whitening]:
    """For each length of vectors, the whitening of floor(scale * entry) + offset."""
    v, size, good = _ready(rows, vector)
    ready = rows.where(good).select(v, size)

    def sums(size: int, vectors: np.ndarray) -> np.ndarray:
        x = _whole(vectors, scale, offset)
        total = [sum(map(int, c)) for c in x.T] if np.abs(x).max(initial=0) * len(x) >= _EXACT else x.sum(axis=0).astype(np.int64).tolist()
        return np.array([[len(x), *total]], dtype=object)

    whole = {size: [int(t) for t in m[0]] for size, m in _matrices(_summed(ready, sums, _TOTAL, "decimal(38,0)")).items()}
    shifts = {size: np.array([(2 * t + n) // (2 * n) for t in s], dtype=np.float64) for size, (n, *s) in whole.items()}

    def products(size: int, vectors: np.ndarray) -> np.ndarray:
        return _products(_whole(vectors, scale, offset) - shifts[size])

    grams = _matrices(_summed(ready, products, _TOTAL, "decimal(38,0)"))
    return {size: _whitening(whole[size][0], whole[size][1:], shifts[size], gram, components) for size, gram in grams.items()}


def _whitening(n: int, sums: list[int], shift: np.ndarray, gram: np.ndarray, components: int) -> Whitening:
    rest = np.array([s - n * int(t) for s, t in zip(sums, shift)], dtype=object)
    # n**2 times the covariance, in whole numbers; rounded once.
    whole = n * np.array([[int(t) for t in row] for row in gram], dtype=object) - np.outer(rest, rest)
    v = np.array([[HIGH(str(t)) for t in row] for row in whole], dtype=HIGH) / (HIGH(n) * HIGH(n))
    values, vectors = spectral(v)
    trace = float(np.trace(v))
    values = np.where(values > NOTHING * trace, values, 0).astype(np.float64)[:components]
    explained = values / trace if trace else np.zeros(len(values))
    return Whitening(n, shift, rest, values, vectors[:, :components].astype(np.float64), explained)


def identity_errors(rows: DataFrame, fits: dict[int, Whitening], vector: str = "embedding", scale: float = 64.0, offset: int = 1_000_000) -> dict[int, float]:
    """For each length, the largest entry of the whitened rows' covariance minus the identity, measured over all rows."""
    v, size, good = _ready(rows, vector)

    def products(size: int, vectors: np.ndarray) -> np.ndarray:
        fit = fits[size]
        w = fit.apply(_whole(vectors, scale, offset))[:, fit.values > 0]
        w = np.c_[np.ones(len(w)), w]
        return w.T @ w

    out = {}
    for size, total in _matrices(_summed(rows.where(good).select(v, size), products, pa.float64(), "double")).items():
        total = total.astype(np.float64) / fits[size].n
        covariance = total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:])
        out[size] = float(np.abs(covariance - np.eye(len(covariance))).max()) if len(covariance) else 0.0
    return out


def whitened(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 32, scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) for every usable row, the components as arrays."""
    fits = fit(rows, vector, components, scale, offset)
    errors = identity_errors(rows, fits, vector, scale, offset)
    v, size, good = _ready(rows, vector)
    key = rows.schema[id]
    kind = "array<double>"
    schema = f"n bigint, deviation bigint, whitened {kind}, explained {kind}, identity_error double"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, here, vectors in _by_size(batch):
                fit, x = fits[size], _whole(vectors, scale, offset)
                w = fit.apply(x)
                k = np.arange(len(x) + 1) * w.shape[1]
                lists = [pa.ListArray.from_arrays(pa.array(k, pa.int32()), pa.array(flat, mask=np.isnan(flat))) for flat in (w.ravel(), np.tile(fit.explained, len(x)))]
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(here)), pa.array(np.full(len(x), fit.n)), pa.array(fit.deviation(x), pa.int64()),
                    *lists, pa.array(np.full(len(x), errors[size])),
                ], names=["id", "n", "deviation", "whitened", "explained", "identity_error"])

    ready = rows.where(good).select(F.col(f"`{id}`").alias("id"), v, size)
    found = ready.mapInArrow(step, f"id {key.dataType.simpleString()}, {schema}")
    return found.withColumnRenamed("id", id)
