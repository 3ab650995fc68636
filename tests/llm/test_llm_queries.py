"""The registered queries against their SQL, and the pipeline's stages against plain versions."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm.queries import ORACLES, QUERIES
from parity import actual, connect, expected

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, connection, name):
    assert actual(QUERIES[name](spark, FOLDER)) == expected(connection, ORACLES[name])


def test_operators_and_the_pipeline_are_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_pipeline_stages(spark, monkeypatch):
    from test_text_operators import plain_fingerprint, plain_pieces, plain_roots, plain_substrings

    kept = []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, lambda s, d, f, g=g: kept.append(g(s, d, f).collect()) or s.createDataFrame(kept[-1], d.schema if len(kept) < 5 else None)) for n, g in corpus_pipeline.STAGES])
    corpus_pipeline.run(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    key = lambda r: (r.doc_id, r.text)
    # Toxicity: a part of the documents, and few labelled clean ones go.
    assert set(map(key, kept[0])) <= set(map(key, docs))
    gone = {r.doc_id for r in docs} - {r.doc_id for r in kept[0]}
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i in gone for i in clean) <= 0.03 * len(clean)
    # SimHash: the smallest id of each component.
    label = plain_roots([plain_fingerprint(r.text) for r in kept[0]], 4)
    least = defaultdict(list)
    for r, k in zip(kept[0], label):
        least[k].append(r.doc_id)
    assert sorted(r.doc_id for r in kept[1]) == sorted(map(min, least.values()))
    # Substrings: texts without repeated passages.
    plain = {i: (t, gone) for i, t, _, gone in plain_substrings([(r.doc_id, r.text) for r in kept[1]], corpus_pipeline.WINDOW)}
    before = {r.doc_id: r for r in kept[1]}
    for r in kept[2]:
        text, removed = plain[r.doc_id]
        assert r.text == (text if removed else before[r.doc_id].text)
        assert r.n_chars == (len(text) if removed else before[r.doc_id].n_chars)
    assert len(kept[2]) == len(kept[1])
    # Mixing: each source near its target, no document above three times.
    from millrace.llm.mixing import targets

    sizes = Counter()
    for r in kept[2]:
        sizes[r.source] += len((r.text or "").split())
    goals = targets(dict(sizes), corpus_pipeline.WEIGHTS)
    taken, times = Counter(), Counter()
    for r in kept[3]:
        taken[r.source] += len(r.text.split())
        times[r.doc_id] += 1
    most = max(len((r.text or "").split()) for r in kept[2])
    assert max(times.values()) <= 3 and all(abs(taken[s] - goals[s]) <= most for s in goals)
    # Packing: all pieces of all rows, gapless.
    wide = lambda ids: zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())
    got = Counter((r.doc_id, r.piece, r.start, r.length, wide(r.ids)) for r in kept[4])
    assert got == Counter(plain_pieces([(r.doc_id, r.text) for r in kept[3]], corpus_pipeline.CAPACITY))
    ends = defaultdict(list)
    for r in kept[4]:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= corpus_pipeline.CAPACITY
    assert len(ends) <= 1.02 * sum(r.length for r in kept[4]) / corpus_pipeline.CAPACITY + 1
