"""Whitening against plain eigenvectors, and the refinement on clustered spectra."""

from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import whitening
from millrace.llm.queries import QUERIES
from millrace.llm.whitening import HIGH, spectral, whitened

SCHEMA = "vec_id bigint, embedding array<double>"


def orthogonal(rng, size):
    q = np.linalg.qr(rng.normal(size=(size, size)))[0].astype(HIGH)
    for _ in range(4):
        q = q @ (3 * np.eye(size, dtype=HIGH) - q.T @ q) / 2
    return q


SPECTRA = {
    "pairs closer and closer": [1, 1 + 1e-8, 1 + 1e-8 + 1e-13, 5, 5, 0, 0, 3e-9, 2],
    "spread": list(np.linspace(0.1, 1, 64)),
    "all equal": [1.0] * 5,
    "wide": [1e-12, 1, 1e12] + [2] * 7,
    "few of many": [0] * 60 + [1, 1, 1 + 1e-15],
    "two clusters": [1 + 1e-7 * (k * k % 41) / 41 for k in range(40)] + [1e-3 + 1e-16 * k for k in range(9)],
    "falling": list(10.0 ** -np.arange(30)),
    "one": [3.0],
}


@pytest.mark.parametrize("name", list(SPECTRA))
def test_refined_eigenvectors(name):
    values = np.array(SPECTRA[name], dtype=HIGH)
    q = orthogonal(np.random.default_rng(3), len(values))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    found, x = spectral(v)
    most = np.abs(values).max()
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-17 * most
    assert np.abs(v @ x - x * found).max() <= 1e-17 * most
    assert np.abs(x.T @ x - np.eye(len(values))).max() <= 1e-17


def test_no_covariance():
    found, x = spectral(np.zeros((3, 3)))
    assert not found.any() and (x == np.eye(3)).all()


def plain(rows, size, k):
    good = [(i, v) for i, v in rows if v and len(v) == size and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1000000 for c in v] for _, v in good], dtype=object)
    n, s = len(x), x.sum(axis=0)
    off = n * x - s
    v = (off.T @ off)
    v = np.array([[float(Fraction(int(t), n**3)) for t in row] for row in v])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    centred = np.array([[float(Fraction(int(t), n)) for t in row] for row in off])
    return [i for i, _ in good], n, (off * off).sum(axis=1).tolist(), centred @ vectors / np.sqrt(values), values / np.trace(v)


def vectors(n=220, size=20, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) + 3
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    return rows + [rows[3], (None, rows[5][1]), (400, None), (401, []), (402, [None] * size), (403, [float("nan")] + [1.0] * (size - 1)), (404, [float("-inf")] * size)]


def compared(found, want, k):
    ids, n, deviation, white, explained = want
    assert sorted((r.vec_id, r.n, r.deviation) for r in found if r.vec_id is not None) == sorted((i, n, d) for i, d in zip(ids, deviation) if i is not None)
    by_id = {r.vec_id: r for r in found}
    got = np.array([by_id[i].whitened for i in ids])
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < 1e-9
    assert np.allclose(found[0].explained, explained, rtol=1e-9) and len(found[0].explained) == k
    assert 0 <= found[0].identity_error < 1e-9


@pytest.mark.parametrize("components, parts", [(32, 7), (6, 1)])
def test_whitened(spark, components, parts):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, size string, n int").repartition(parts)
    found = whitened(frame, components=components).collect()
    assert len(found) == 222
    compared(found, plain(rows, 20, components), min(20, components))


def test_lengths_are_apart_and_odd_tables(spark):
    rows = vectors(60, 5) + [(1000 + i, v) for i, v in vectors(50, 3, seed=9) if i is not None and i < 300]
    found = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    for size in (5, 3):
        compared([r for r in found if len(r.whitened) == size], plain(rows, size, 32), size)
    assert whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitened(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []
    # One row and equal rows have no variance.
    for n in (1, 4):
        found = whitened(spark.createDataFrame([(i, [1.5, -2.0]) for i in range(n)], SCHEMA)).collect()
        assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found] == [(n, 0, [None, None], [0.0, 0.0], 0.0)] * n
    # Rows on a line: one component.
    found = whitened(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], SCHEMA)).collect()
    assert all(r.whitened[1] is None and abs(r.explained[0] - 1) < 1e-12 for r in found) and found[0].identity_error < 1e-9


def test_large_entries(spark):
    rows = [(i, [float(i % 7) * 2**28, float(i), 1e300 if i == 3 else 0.0]) for i in range(40)]
    found = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    x = np.array([[int(64 * v[0]), int(64 * v[1]), 2**40 if v[2] else 0] for _, v in rows], dtype=object)
    want = ((40 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert sorted((r.vec_id, r.deviation) for r in found) == [(i, int(t) if t < 2**63 else None) for i, t in enumerate(want)]
    assert found[0].identity_error < 1e-9


def test_products_are_exact():
    rng = np.random.default_rng(5)
    for most in (10, 2**20, 2**24, 2**40):
        y = rng.integers(-most, most + 1, size=(300, 4)).astype(float)
        whole = y.astype(np.int64).astype(object)
        assert (whitening._products(y) == whole.T @ whole).all()


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = QUERIES["op11_embedding_whitening"](spark, folder)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    got = found.collect()
    size = len(rows[0][1])
    ids, n, deviation, white, explained = plain(rows, size, 32)
    k = min(32, len(explained))
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, c + 1) for i in ids for c in range(k))
    cells = {(r.vec_id, r.component): r for r in got}
    sign = [np.sign(cells[ids[0], c + 1].whitened * white[0, c]) for c in range(k)]
    for at, i in enumerate(ids):
        for c in range(k):
            r = cells[i, c + 1]
            assert (r.n, r.deviation) == (n, deviation[at])
            assert abs(r.whitened * sign[c] - white[at, c]) < 1e-6 and abs(r.explained / explained[c] - 1) < 1e-6
            assert r.identity_error <= 1e-4
