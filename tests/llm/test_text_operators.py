"""SimHash, substring dedup, packing, Arrow files and mixing against plain versions on small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import arrow_files, packing, simhash, substrings
from millrace.llm.graph import components
from millrace.llm.joins import BROADCAST_BYTES, join_keyed
from millrace.llm.mixing import mix, mixed, targets
from millrace.llm.words import SLICE_BYTES, hashed
from millrace.session import run_dir

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use or make themselves.
CLASHING = "count bigint, node string, score double, component_id string, piece string, start int, ids string, sequence_id string, offset int, a int, tie string, id string"


def sentence(rng, words, vocabulary=400):
    return " ".join(f"w{n}" for n in rng.integers(0, vocabulary, words))


def corpus(seed=1):
    rng = np.random.default_rng(seed)
    texts = [sentence(rng, int(n)) for n in rng.integers(1, 160, 60)]
    passage, other = sentence(rng, 50), sentence(rng, 36)
    texts += [f"{sentence(rng, 30)} {passage} {sentence(rng, 20)}" for _ in range(8)]
    texts += [f"{sentence(rng, 12)}\n{other}\t {passage}" for _ in range(3)] + [f"{passage} x {passage}"]
    texts += [texts[0]] * 5 + [texts[3] + " more", texts[3].upper(), "  \n ", "", None, "one", "one", " ".join(["la"] * 90)]
    texts += [" ".join([sentence(rng, 5000), passage])]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[5], (None, texts[7], None, None, None), (7, "another text of an id that is there", None, "s1", None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), COLUMNS)


def clashing(spark, rows):
    extra = (1, "n", 0.5, "c", "p", 3, "i", "s", 4, 5, "t", "d")
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{COLUMNS}, {CLASHING}")


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# -- helpers


def test_word_hashes_follow_words_only():
    texts = [b"a b  a\tc", b"", b"  ", b"b", "é ü é".encode(), b"x" * (SLICE_BYTES + 5) + b" a " + b"y z " * SLICE_BYTES]
    got = {}
    for at, parts in hashed(texts):
        got |= {at + i: p for i, p in enumerate(parts)}
    names = {}
    for i, text in enumerate(texts):
        words = text.split()
        assert len(got[i]) == len(words)
        for h, w in zip(got[i].tolist()[:50], words):
            assert names.setdefault(h, w) == w
    assert len(names) == len({w for t in texts for w in t.split()[:50]})


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (5, None), (60, 20), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {i: 20 for i in range(20, 61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# -- SimHash


def plain_fingerprint(text, words=4):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, bits):
    values = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= bits
    label = np.arange(len(values))
    while True:
        lower = np.array([label[row].min() for row in near])
        if (lower == label).all():
            return label
        label = lower


def test_simhash_components(spark, docs):
    rows = corpus()
    prints = [plain_fingerprint(r[1]) for r in rows]
    label = plain_roots(prints, 4)
    least = {k: min((r[0] for r, x in zip(rows, label) if x == k and r[0] is not None), default=None) for k in set(label)}
    want = [(r[0], f"{p:016x}", least[k]) for r, p, k in zip(rows, prints, label)]
    got = simhash.simhash_components(docs, keep=["doc_id"]).select("doc_id", F.lower(F.lpad(F.hex("_sim_print"), 16, "0")), "component_id")
    assert in_order(got.collect()) == in_order(want)


def test_simhash_dedup_keeps_one_row_of_each_component(spark):
    rows = corpus()
    label = plain_roots([plain_fingerprint(r[1]) for r in rows], 4)
    got = simhash.simhash_dedup(clashing(spark, rows)).collect()
    assert len(got) == len(set(label))
    least = {}
    for r, k in zip(rows, label):
        least[k] = min(least.get(k, (True, 0)), (r[0] is None, r[0] or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(least.values())
    assert simhash.simhash_dedup(empty(spark)).collect() == []


def test_simhash_dedup_writes_no_texts(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.bytes(4000).hex(), "en", "s", 8000) for i in range(60)]
    folder = Path(run_dir(spark))
    files = lambda: {f: f.stat().st_size for f in folder.rglob("*.parquet") if f.is_file()}
    before = files()
    got = simhash.simhash_dedup(spark.createDataFrame(rows, COLUMNS)).collect()
    assert in_order(got) == in_order(rows)
    texts = sum(len(r[1]) // 2 for r in rows)
    assert sum(size for f, size in files().items() if f not in before) < texts / 2


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_simhash_dedup_of_equal_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "join_keyed", lambda *a: join_keyed(*a, limit=limit))
    rng = np.random.default_rng(9)
    first, second, third, fourth = (sentence(rng, 60, 10**6) for _ in range(4))
    rows = [(1, first, "en", "s", 1), (1, first, "de", "s", 1), (2, first, "en", "s", 1), (None, second, None, None, None), (None, third, "en", None, 3)]
    rows += [(None, fourth, None, "s", 4), (None, None, fourth, "s", 4)]
    docs = spark.createDataFrame([*rows, *rows, *rows[3:]], COLUMNS).repartition(5)
    got = simhash.simhash_dedup(docs).collect()
    assert len(got) == 5 and set(map(tuple, got)) <= set(rows)
    assert {(r.doc_id, r.text) for r in got} == {(1, first), (None, second), (None, third), (None, fourth), (None, None)}


@pytest.mark.parametrize("group_rows, bits", [(1 << 11, 4), (8, 4), (8, 2), (2, 6)])
def test_trie_join_finds_all_links(spark, monkeypatch, group_rows, bits):
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(simhash, "LEAF_PAIRS", 6)
    rng = np.random.default_rng(3)
    values = list(rng.integers(0, 1 << 63, 150, dtype=np.uint64) * np.uint64(2))
    for _ in range(350):
        flips = rng.choice(64, rng.integers(1, 7), replace=False)
        values.append(values[rng.integers(0, len(values))] ^ np.uint64(sum(1 << int(b) for b in flips)))
    values = np.unique(np.array(values, dtype=np.uint64))
    signed = values.view(np.int64)
    frame = spark.createDataFrame([(int(v),) for v in signed], "_sim_print bigint")
    got = dict(map(tuple, components(simhash.links(frame, bits)).collect()))
    label = plain_roots(values, bits)
    groups = defaultdict(list)
    for v, k in zip(signed.tolist(), label):
        groups[k].append(v)
    assert got == {v: min(g) for g in groups.values() if len(g) > 1 for v in g}


def test_bit_orders_grow_with_the_input():
    sizes = [len(simhash.orders(n, 4)) for n in (10, 10**6, 10**8, 10**10)]
    assert sizes == sorted(sizes) and sizes[0] == 5 and sizes[-1] > 5
    for order in simhash.orders(10**9, 4):
        assert sorted(b for s, w in order for b in range(s, s + w)) == list(range(64))


# -- substrings


def plain_substrings(rows, window):
    words = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], kept.decode(), len(w), len(gone)))
    return out


@pytest.mark.parametrize("window, chunk", [(35, 1 << 22), (35, 100), (3, 1 << 22), (1, 1 << 22), (90, 64)])
def test_substring_dedup(spark, docs, monkeypatch, window, chunk):
    monkeypatch.setattr(substrings, "CHUNK_WORDS", chunk)
    got = substrings.substring_dedup(docs, window=window, keep=["doc_id"]).collect()
    assert in_order(got) == in_order(plain_substrings(corpus(), window))


def test_substring_dedup_cuts_long_texts_in_chunks_alike(monkeypatch):
    from millrace.llm import words

    rng = np.random.default_rng(5)
    text = " ".join(sentence(rng, 400, 30) for _ in range(6)).encode()
    whole = list(substrings._texts_runs([text], 35))
    monkeypatch.setattr(substrings, "CHUNK_WORDS", 37)
    monkeypatch.setattr(words, "SLICE_BYTES", 100)
    parts = list(substrings._texts_runs([text], 35))
    count = lambda runs: sum(int(n.sum()) for *_, n in runs)
    assert count(whole) == count(parts) == 2400 - 34


def test_substring_dedup_of_other_columns_and_nothing(spark):
    rows = corpus()[:20]
    got = substrings.substring_dedup(clashing(spark, rows)).collect()
    assert len(got) == 20 and set(got[0].asDict()) >= {"count", "tie", "_sub_kept"}
    assert substrings.substring_dedup(empty(spark)).collect() == []


# -- packing


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan_is_gapless_whole_and_tight(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([7, 64, 100]))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 600))) if seed % 2 else rng.integers(1, capacity // 2 + 2, 500)
    counts = Counter(lengths.tolist())
    slots, sequences = packing.plan(counts, capacity)
    bins, numbers = defaultdict(list), defaultdict(list)
    for length, low, high, per, first, offset in slots.tolist():
        for number in range(low, high):
            place = number - low
            bins[first + place // per].append((offset + place % per * length, length))
            numbers[length].append(number)
    assert {k: sorted(v) for k, v in numbers.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sorted(bins) == list(range(sequences))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    large = sorted((x for x in lengths.tolist() if 3 * x > capacity), reverse=True)
    alone = 0
    while large:  # the greedy matching itself, item by item
        one = large.pop(0)
        partner = next((i for i, x in enumerate(large) if x + one <= capacity), None)
        alone += 1
        if partner is not None:
            large.pop(partner)
    total = -(-int(lengths.sum()) // capacity)
    assert max(total, alone) <= sequences <= max(alone, int(1.2 * total) + 1)


def plain_pieces(rows, capacity, name="word_bpe_49k.json"):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    for r in rows:
        ids = np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for number, at in enumerate(range(0, len(ids), capacity)):
            yield r[0], number, at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes())


@pytest.mark.parametrize("chunk_rows", [1 << 20, 1])
def test_pack_documents(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(packing, "CHUNK_ROWS", chunk_rows)
    rows = corpus()
    got = packing.pack_documents(clashing(spark, rows), public_tokenizers.path("word_bpe_49k.json"), 128).collect()
    assert in_order((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got) == in_order(plain_pieces(rows, 128))
    assert {r["tie"] for r in got} == {"t"}
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 128
    assert len(bins) <= 1.02 * sum(r.length for r in got) / 128 + 1


def test_pack_odd_items(spark):
    assert packing.pack_documents(empty(spark), public_tokenizers.path("word_bpe_49k.json")).collect() == []
    got = packing.pack(spark.createDataFrame([(1, None), (2, 0), (3, 5), (3, 5)], "i int, length int"), 10).collect()
    assert [(r.i, r.sequence_id, r.offset) for r in sorted(got, key=lambda r: (r.i, r.offset or 0))] == [(1, None, None), (2, None, None), (3, 0, 0), (3, 0, 5)]
    with pytest.raises(ValueError, match="longer than 10"):
        packing.pack(spark.createDataFrame([(11,)], "length int"), 10)


# -- Arrow files


def test_arrow_files_round_trip(spark, docs, tmp_path):
    name, rows = "byte_bpe_50k.json", sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0))
    folder = str(tmp_path / "shards")
    manifest = arrow_files.write_arrow(docs.repartition(5), public_tokenizers.path(name), folder, length=64)
    got = arrow_files.read_documents(manifest, folder, docs.schema["doc_id"].dataType).collect()
    pieces = [p for p in plain_pieces(rows, 10**9, name)]
    assert in_order((r.id, r.tokens, r.ids_crc32) for r in got) == in_order((p[0], p[3], p[4]) for p in pieces)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.tokens
    order = [r.id for r in sorted(got, key=lambda r: r.start)]
    assert order == [r[0] for r in rows]
    for r in manifest.collect():
        reader = arrow_files.open_sequences(folder, r.file)
        before = pa.total_allocated_bytes()
        batch = reader.get_batch(0)
        view = batch.column(0).flatten().to_numpy(zero_copy_only=True).reshape(-1, 64)
        assert pa.total_allocated_bytes() == before and view.shape == (batch.num_rows, 64)
        assert sum(reader.get_batch(i).column(1).flatten().true_count for i in range(reader.num_record_batches)) == r.tokens


def test_arrow_files_carry_no_other_columns(spark, docs, tmp_path):
    """Columns named like those of the files do not matter."""
    folder = str(tmp_path / "clashing")
    wide = docs.selectExpr("*", "1 AS id", "'x' AS start", "2 AS tokens", "3 AS shard", "4 AS tie")
    manifest = arrow_files.write_arrow(wide, public_tokenizers.path("byte_bpe_50k.json"), folder, length=64)
    got = arrow_files.read_documents(manifest, folder, docs.schema["doc_id"].dataType).collect()
    assert in_order((r.id, r.tokens) for r in got) == in_order((p[0], p[3]) for p in plain_pieces(corpus(), 10**9, "byte_bpe_50k.json"))


def test_folders_are_those_of_the_session(spark, tmp_path):
    assert arrow_files.qualified(spark, str(tmp_path)) == f"file://{tmp_path}" == arrow_files.qualified(spark, f"file:{tmp_path}")
    before = spark.conf.get("spark.hadoop.fs.defaultFS", None)
    conf = spark._jsc.hadoopConfiguration()
    kept = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://cluster/")
    conf.set("fs.viewfs.mounttable.cluster.link./shared", f"file://{tmp_path}")
    try:
        assert arrow_files.qualified(spark, "/shared/x") == "viewfs://cluster/shared/x" and before is None
    finally:
        conf.set("fs.defaultFS", kept)


def test_arrow_files_of_nothing(spark, tmp_path):
    manifest = arrow_files.write_arrow(empty(spark), public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path))
    assert arrow_files.read_documents(manifest, str(tmp_path), "long").collect() == []


def test_long_texts_are_encoded_in_parts_alike(monkeypatch):
    from millrace.llm import tokens

    rng = np.random.default_rng(2)
    text = " ".join(rng.choice(["word", "été", "x1", "don't", "\n\n", "  ", "a-b", "!!", "<|endoftext|>", "日本"], 4000))
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        monkeypatch.setattr(tokens, "RUN_BYTES", 300)
        assert len(tokens._parts(text)) > 10
        assert next(tokens.encoded(pa.array([text]), path)).tolist() == want
        monkeypatch.undo()


def test_pieces_are_encoded_like_whole_texts(monkeypatch):
    from millrace.llm import tokens

    odd = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "é\u00a0ü", "a \u2003b", "a\u2003b c", "don't 's x", "<|endoftext|> a", "  lead"]
    odd += ["x\x1c y", "İ İa Σ ΑΣ ſ ŉ", "e \u0301x", "Été, ÉTÉ. a.b a,, .a , .", "ﬁn ǅ ß.", None, "word. Word, WORD"]
    rng = np.random.default_rng(0)
    odd += ["".join(rng.choice(["a", " ", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|end", "of", "é", ".", "\n"], 12)) for _ in range(300)]
    odd += ["".join(rng.choice(list("ab é'.,1 \n\t\u0301ΣİS s<|>日"), 60)) for _ in range(400)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        library = Tokenizer.from_file(path)
        want = [library.encode(t or "", add_special_tokens=False).ids for t in odd]
        assert [ids.tolist() for ids in tokens.encoded(pa.array(odd), path)] == want
        monkeypatch.setattr(tokens, "RUN_BYTES", 50)
        monkeypatch.setattr(tokens, "REMEMBERED", 100)
        assert [ids.tolist() for ids in tokens.encoded(pa.array(odd[::-1]).slice(2), path)] == want[::-1][2:]
        monkeypatch.undo()


# -- mixing


def test_targets_stop_and_share_again():
    assert targets({"b": 100, "a": 100, None: 10}, (1, 2, 3)) == {"a": 60.0, "b": 120.0, None: 30.0}
    got = targets({"a": 10, "b": 10, "c": 980}, (1, 2, 3))
    assert got["a"] == got["b"] == 30.0 and got["c"] == 940.0
    assert targets({}, (1, 2, 3)) == {}
    assert targets({"a": 0}, (1,)) == {"a": 0.0}


def test_mix_reaches_its_targets_and_is_stable(spark):
    rng = np.random.default_rng(4)
    rows = [(i, sentence(rng, int(rng.integers(0, 40))), "en", ["a", "b", "c", None][min(3, int(rng.integers(0, 9)) // 2)], 0) for i in range(800)]
    rows += [(900, "one two three", "en", "b", 0)] * 150 + [(901, None, "en", "c", 0), (None, "x y", None, None, None)]
    runs = [sorted((tuple(r) for r in mix(spark.createDataFrame(rows, COLUMNS).repartition(n), keep=["doc_id"]).collect()), key=repr) for n in (3, 7)]
    assert runs[0] == runs[1]
    taken = mix(spark.createDataFrame(rows, COLUMNS)).collect()
    for source in ("a", "b", "c", None):
        own = [r for r in taken if r.source == source]
        words = sum(r._mix_size * r._mix_times for r in own)
        assert abs(words - own[0]._mix_target) <= 40
        assert own[0]._mix_source_size == sum(len((r.text or "").split()) for r in own)
        assert all(0 <= r._mix_times <= 3 for r in own)
    copies = mixed(clashing(spark, rows)).groupBy("doc_id").count().collect()
    want = Counter()
    for r in taken:
        want[r.doc_id] += r._mix_times
    assert {r[0]: r[1] for r in copies} == {k: n for k, n in want.items() if n}
    assert mix(empty(spark)).collect() == []


def test_kept_words_hash(spark, docs):
    from millrace.llm.queries import QUERIES  # the digest is of the operator's own text

    found = substrings.substring_dedup(docs, keep=["doc_id"]).select("_sub_kept", F.sha2("_sub_kept", 256)).collect()
    assert all(hashlib.sha256(t.encode()).hexdigest() == h for t, h in found) and "op4_substring_dedup" in QUERIES
