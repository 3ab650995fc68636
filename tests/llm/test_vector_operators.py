"""Embedding near-dedup and exact top-k search against plain versions on small tables."""

import signal

import numpy as np
import pytest

from millrace.llm import covertree, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def embeddings(seed=0, n=160, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, d))
    rows = []
    for i in range(n):
        v = centres[i % 25] + rng.normal(size=d) * rng.choice([0, 0.05, 0.2, 0.5])
        rows.append((i, [float(x) for x in np.float32(v)], i % 3 if i % 11 else None))
    rows += [(200 + i, [float(x) for x in np.float32(centres[0])], 0) for i in range(6)] + [rows[3]]
    rows += [(300, None, 1), (301, [0.0] * d, 1), (302, [float("nan")] * d, 1), (303, [1.0] * (d - 1) + [None], 1)]
    rows += [(304, [float("inf")] + [1.0] * (d - 1), 1), (305, [1.0, 2.0], 1), (306, [2.0, 4.0], 1), (307, [], 1), (None, rows[3][1], rows[3][2])]
    return rows


def good(row, zero=False):
    v = row[1]
    return v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))


def plain_links(rows, threshold):
    n = len(rows)
    near = np.zeros((n, n), dtype=bool)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and good(a) and good(b) and a[2] is not None and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                near[i, j] = a[1] == b[1] or x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold
    label = np.arange(n)
    while True:
        lower = np.array([min(label[i], label[near[i]].min(initial=n)) for i in range(n)])
        if (lower == label).all():
            break
        label = lower
    least = {k: min((r[0] for r, x in zip(rows, label) if x == k and r[0] is not None), default=None) for k in set(label)}
    return [(r[0], int(near[i].sum()), least[label[i]]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("tile, threshold", [(2048, 0.93), (5, 0.93), (16, 0.6)])
def test_vector_components(spark, monkeypatch, tile, threshold):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 7)
    monkeypatch.setattr(vectors, "EXACT_PAIRS", 3)
    rows = embeddings()
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, "x") for r in rows], f"{SCHEMA}, node int, copies int, size int, n_links int, component_id string")
    got = vectors.vector_components(frame, threshold=threshold).select("vec_id", "n_links", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_links(rows, threshold), key=repr)


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    for d in (1, 3, 64, 1500):
        x, y = vectors.unit(rng.normal(size=(40, d)) ** 3 + 1e-3), vectors.unit(rng.normal(size=(30, d)) ** 3 + 1e-3)
        (qx, sx, nx, ex), (qy, sy, _, ey) = vectors.quantised(x), vectors.quantised(y)
        bound = (qx.astype(int) @ qy.astype(int).T) * sx[:, None] * sy[None, :] + nx[:, None] * ey[None, :] + ex[:, None]
        assert (bound >= x @ y.T - 1e-12).all()
        pairs = {p for a, b in vectors.tile_links(x, y, False, 0.05) for p in zip(a.tolist(), b.tolist())}
        assert pairs == set(zip(*(i.tolist() for i in np.nonzero(x @ y.T >= 0.05))))


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vectors.vector_components(none).collect() == []
    assert covertree.top_products(none, none).collect() == []
    odd = spark.createDataFrame([(1, None, 1), (2, [0.0], None)], SCHEMA)
    got = vectors.vector_components(odd).select("vec_id", "n_links", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2)]


def plain_top(rows, k, every, scale=256):
    whole = [(r[0], [int(np.floor(scale * x)) for x in r[1]]) for r in rows if r[0] is not None and good(r, zero=True)]
    out = []
    for i, q in whole:
        if i % every == 0:
            scores = [(-sum(a * b for a, b in zip(q, p)), j) for j, p in whole if j != i and len(p) == len(q)]
            out += [(i, rank, j, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks, seeds, factor", [((2048, 2048), 1024, 1.0), ((20, 9), 8, 1.0), ((30, 1000), 50, 1e-3), ((2048, 2048), 20, 1e6)])
def test_top_products(spark, monkeypatch, blocks, seeds, factor):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(covertree, "BLOCK_QUERIES", blocks[1])
    monkeypatch.setattr(covertree, "SEED_ROWS", seeds)
    monkeypatch.setattr(covertree, "LEAF_QUERIES", 2)
    rows = [(r[0], None if r[1] is None else [None if x is None else float(np.float32(x * factor)) for x in r[1]], r[2]) for r in embeddings(5)]
    rows.remove(rows[166])  # repeated query rows have repeated results
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{SCHEMA}, row int, score string")
    got = covertree.top_products(frame, frame.where("vec_id % 7 = 0"), k=5).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, 5, 7)


def point_sets():
    rng = np.random.default_rng(2)
    mixed = np.floor(rng.normal(size=(300, 6)) * 100)
    mixed[50:90] = mixed[50]
    copies = rng.integers(-9, 9, size=(700, 8)).astype(float)
    copies[rng.random(700) < 0.3] = copies[0]
    line = np.outer(rng.integers(-500, 500, size=400), [1.0, 2.0, -1.0])
    middle = np.array([[5.0, 0.0], *[[0.0, 0.0]] * 6, [10.0, 0.0]])
    return {
        "mixed": mixed, "copies": copies, "collinear": line, "centre is not first": middle,
        "one dimension": rng.normal(size=(2048, 1)), "two dimensions": rng.normal(size=(2048, 2)),
        "eight dimensions": rng.normal(size=(2048, 8)), "all equal": np.ones((50, 3)), "one point": np.ones((1, 3)),
    }


@pytest.mark.parametrize("name", list(point_sets()))
@pytest.mark.parametrize("leaf", [1, 16])
def test_cover_trees_cover(name, leaf):
    points = point_sets()[name]
    signal.alarm(60)
    try:
        tree = covertree.CoverTree(points, leaf)
    finally:
        signal.alarm(0)
    assert len(tree.low) <= 2 * len(points)
    for node in range(len(tree.low)):
        own = tree.order[tree.low[node] : tree.high[node]]
        assert np.sqrt(((points[own] - points[tree.centre[node]]) ** 2).sum(axis=1)).max() <= tree.radius[node] + 1e-6
        below = [tree.order[tree.low[c] : tree.high[c]] for c in range(tree.first[node], tree.last[node])]
        assert not below or (len(below) > 1 and sorted(np.concatenate(below)) == sorted(own))


@pytest.mark.parametrize("rows", [[[5.0, 0.0], *[[0.0, 0.0]] * 6, [10.0, 0.0]], [[float(x)] for x in range(-20, 20)]])
def test_top_products_of_few_dimensions(spark, rows):
    rows = [(i, v, 0) for i, v in enumerate(rows)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = covertree.top_products(frame, frame, k=3).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, 3, 1)


def test_queries_visit_few_pivots_of_clustered_rows(spark, monkeypatch):
    """Rows around far apart centres: a query's vector is copied to few groups of rows, and nothing is lost."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 10)) * 20
    rows = [(i, [float(x) for x in np.float32(centres[i % 40] + rng.normal(size=10) * 0.3)], 0) for i in range(2400)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 50)
    visits, real = [], covertree._searched

    def counted(asked, near, covers, k, kind):
        visits.append((asked.selectExpr("sum(size(pivots))").first()[0], covers.count()))
        return real(asked, near, covers, k, kind)

    monkeypatch.setattr(covertree, "_searched", counted)
    queries = frame.where("vec_id % 10 = 0")
    got = covertree.top_products(frame, queries, k=5).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, 5, 10)
    assert visits[0] == (240, visits[0][1]) and visits[0][1] > 30
    assert visits[0][0] + visits[1][0] < 0.15 * 240 * visits[0][1]
