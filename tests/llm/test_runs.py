"""Periodic runs against every period tried, and the query against its contract word by word."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

from millrace.llm import runs as module
from millrace.llm.queries import QUERIES
from millrace.llm.runs import periodic_runs, runs


def plain_runs(words, least=1, repeats=4):
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            long = length >= max(least, repeats * q)
            if long and not any(words[i : i + length - p] == words[i + p : i + length] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_kept(words, found):
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def odd_words(rnd, n):
    kinds = rnd.choice([1, 2, 3, 50])
    words = [rnd.randrange(kinds) for _ in range(n)]
    for _ in range(rnd.randrange(4)):
        a = rnd.randrange(n or 1)
        p = 1 + rnd.randrange(max(1, (n - a) // 3))
        for i in range(a + p, min(n, a + p * rnd.randrange(2, 9) + rnd.randrange(p))):
            words[i] = words[i - p]
    return words


def together(docs, repeats=4):
    first = np.r_[0, np.cumsum([len(d) for d in docs])]
    found = runs(np.array([x for d in docs for x in d], dtype=np.int64), first, repeats)
    return [tuple(r) for r in np.stack(found, axis=1).tolist()], [(a + int(f), b, c) for d, f in zip(docs, first) for a, b, c in plain_runs(d, repeats=repeats)]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_documents(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        got, want = together([odd_words(rnd, rnd.choice([0, 1, 2, 5, 8, 20, 60, 150])) for _ in range(rnd.randrange(1, 6))], rnd.choice([4, 4, 5, 7]))
        assert got == want


def special():
    a, b = [0], [0, 1]
    for _ in range(11):
        a, b = b, b + a
    morse = [bin(i).count("1") & 1 for i in range(512)]
    ladder = []
    for _ in range(4):
        ladder = ladder * 4 + [len(ladder)]
    return {
        "fibonacci": b[:400], "thue morse": morse * 5, "one word": [7] * 300, "nested": ladder * 5,
        "a run in a run": ([1, 1, 1, 1, 2] * 6 + [3]) * 5, "broken once": [1, 2, 3] * 50 + [9] + [1, 2, 3] * 50,
        "long period": list(range(64)) * 5, "period beyond a power": list(range(65)) * 4 + [0], "just too short": list(range(65)) * 3 + list(range(64)),
        "pairs": [x for i in range(100) for x in (i, i)], "no words": [],
    }


@pytest.mark.parametrize("name", list(special()))
@pytest.mark.parametrize("block", [1 << 20, 16])
def test_runs_of_special_words(monkeypatch, name, block):
    monkeypatch.setattr(module, "_BLOCK", block)
    words = special()[name]
    got, want = together([words, [1, 2], words, words[::-1]])
    assert got == want


def test_many_words_take_few_steps():
    """A long text of one word, and one of words that never repeat."""
    n = 300_000
    first = np.array([0, n, 2 * n])
    found = runs(np.r_[np.zeros(n, dtype=np.int64), np.arange(n)], first)
    assert np.stack(found, axis=1).tolist() == [[0, n, 1]]


def test_too_few_repeats():
    with pytest.raises(ValueError, match="4 repeats"):
        runs(np.arange(3), np.array([0, 3]), 3)


TEXTS = [
    None, "", " \t\n", "one", "a a a a a", "a a a a a a", "x  a\ta\na a\x0ba\x0ca y", "la\u00a0 la la la la la la", "\u0130 \u0130 \u0130 \u0130 \u0130 \u0130 i",
    "to be or not " * 4, "to be or not " * 4 + "to be", "a b " * 9 + "c " + "a b " * 9,
    " ".join(f"w{i % 70}" for i in range(70 * 4 + 1)), "z" * 3000 + " " + "q " * 5000, "x y z " * 40 + "x x x x x x x",
]


def test_periodic_runs(spark, monkeypatch):
    monkeypatch.setattr(module, "SLICE_BYTES", 400)
    data = [(i, t, i, "n", [i]) for i, t in enumerate(TEXTS)] + [(None, TEXTS[5], 1, "n", None)] * 2
    frame = spark.createDataFrame(data, "doc_id int, text string, start int, kept string, length array<int>").repartition(3)
    found = periodic_runs(frame).collect()
    want = []
    for i, text, *_ in data:
        words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
        rows = [r for r in plain_runs(words, 6)]
        want.append((i, text, rows, plain_kept(words, rows)))
    assert sorted(((r.doc_id, r.text, [tuple(x) for x in r._run_found], r._run_kept) for r in found), key=repr) == sorted(want, key=repr)
    assert found[0].asDict().keys() == {"doc_id", "text", "start", "kept", "length", "_run_found", "_run_kept"}
    assert periodic_runs(frame.limit(0)).collect() == []


def contract(doc_id, text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words, 6)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *first, sha256(lines.encode()).hexdigest(), sha256(plain_kept(words, found).encode()).hexdigest())


def test_query(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000").select("doc_id", "text")
    more = spark.createDataFrame([(10_000 + i, t) for i in range(40) for t in TEXTS[:12]] + [(None, "a a a a a a")], "doc_id bigint, text string")
    docs.union(more).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in found.dtypes if c not in ("runs_sha256", "collapsed_sha256")} == {"bigint"}
    got = sorted(map(tuple, found.collect()), key=repr)
    want = sorted((contract(r.doc_id, r.text) if r.doc_id is not None else (None, *contract(1, r.text)[1:]) for r in docs.union(more).collect()), key=repr)
    assert got == want
    assert sum(r[1] > 0 for r in got) > 50
