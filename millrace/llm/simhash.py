"""SimHash near-duplicates: fingerprints of word shingles, joined by a binary trie self-join.

*Fingerprints.* A text is lower-cased (A-Z only) and cut into words; its shingles of n words,
repeats included and joined by one space (fewer words: the whole sequence), are hashed by
XXH64, and a bit of the fingerprint is 1 if set in over half of the hashes.

*Links.* Two fingerprints are linked if they differ in at most `max_bits` bits. The trie of
all fingerprints is cut into groups that fit one task: the 64 bits are dealt into
max_bits + m blocks, so two linked fingerprints agree in m whole blocks, and for every choice
of m blocks those bits come first in the trie's bit order. Only node pairs that agree there
are entered, and m grows with the number of fingerprints. Inside a group the trie is joined
with itself: a pair of nodes goes to the pairs of their children, a step to unlike children
costs one differing bit, and a pair beyond `max_bits` is dropped.

*Hot groups* above GROUP_ROWS fingerprints are dealt into tiles by hash, and each pair of
tiles is a task of its own: no task grows with the group. Only a spanning forest of a
task's links leaves it, never all pairs. Copies share one fingerprint and are joined once.

Nulls: a null text has no words. No words: fingerprint zero, linked like any other. Repeated
rows and repeated ids are rows of their own. A null id takes part, but never names a
component unless all of its ids are null. Empty tables give no rows. Other columns,
whatever their names, are carried along; helper columns have names starting `_sim`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.graph import components, forest
from millrace.llm.joins import join_keyed
from millrace.llm.words import utf8
from millrace.operators.attach import attach
from millrace.session import written

#: Fingerprints of one group that one task joins; larger groups are tiled.
GROUP_ROWS = 2048
#: Node pairs with at most this many pairs of fingerprints are compared directly.
LEAF_PAIRS = 64
#: Node pairs, and fingerprints of small groups, that a task works on at once.
FRONTIER = 1 << 20
TASK_ROWS = 1 << 16


def fingerprint(text: bytes, words: int) -> int:
    import xxhash

    parts = text.lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(b" ".join(parts), 42)
    plain = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = np.zeros(64, dtype=np.int64)
    shingles = len(parts) - words + 1
    for at in range(0, shingles, FRONTIER // 16):
        to = min(shingles, at + FRONTIER // 16)
        first, last = starts[at:to].tolist(), ends[at + words - 1 : to + words - 1].tolist()
        hashes = np.array([digest(plain[i:j], 42) for i, j in zip(first, last)], dtype=">u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > shingles).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text", words: int = 4, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or only its columns `keep`) and `_sim_print`, the fingerprint as a signed bigint."""
    kept = docs.columns if keep is None else keep
    body = text if text in kept else "_sim_text"
    chosen = docs.select(*[F.col(f"`{c}`") for c in kept], *([] if body == text else [F.col(f"`{text}`").alias(body)]))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words) for t in utf8(batch.column(body))]
            out = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], out], names=[*kept, "_sim_print"])

    fields = [f for f in chosen.schema.fields if f.name != "_sim_text"]
    return chosen.mapInArrow(prints, StructType([*fields, StructField("_sim_print", LongType())]))


def _blocks(count: int) -> list[tuple[int, int]]:
    """(start, width) of `count` runs of bits, from the top."""
    edges = [round(64 * i / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def orders(distinct: int, max_bits: int) -> list[list[tuple[int, int]]]:
    """Bit orders, as blocks: the first m blocks are those in which linked fingerprints agree."""
    match = 1
    while match < 5 and distinct / 2 ** (64 * match // (max_bits + match)) > GROUP_ROWS / 2:
        match += 1
    blocks = _blocks(min(64, max_bits + match))
    return [[*chosen, *(b for b in blocks if b not in chosen)] for chosen in combinations(blocks, len(blocks) - max_bits)]


def _reordered(values: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(len(values), dtype=np.uint64)
    for start, width in order:
        part = (values >> np.uint64(64 - start - width)) & np.uint64((1 << width) - 1)
        out = (out << np.uint64(width)) | part
    return out


def trie_pairs(values: np.ndarray, frontier: np.ndarray, depth: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of `values` (sorted within each node) at most `max_bits` bits apart.

    `frontier` has the columns (from, to, from, to, bits) of node pairs that agree in the
    first `depth` bits; a node paired with itself gives each pair once.
    """
    while len(frontier):
        if len(frontier) > FRONTIER:
            for at in range(0, len(frontier), FRONTIER // 4):
                yield from trie_pairs(values, frontier[at : at + FRONTIER // 4], depth, max_bits)
            return
        al, ah, bl, bh, bits = frontier.T
        size = (ah - al) * (bh - bl)
        leaf = (size <= LEAF_PAIRS) | (depth >= 64)
        if leaf.any():
            small = frontier[leaf]
            for at in range(0, len(small), FRONTIER // LEAF_PAIRS):
                yield _leaf_pairs(values, small[at : at + FRONTIER // LEAF_PAIRS], max_bits)
        frontier = frontier[~leaf]
        if not len(frontier):
            return
        al, ah, bl, bh, bits = frontier.T
        zeros = np.zeros(len(values) + 1, dtype=np.int64)
        np.cumsum((values >> np.uint64(63 - depth)) & np.uint64(1) == 0, out=zeros[1:])
        am, bm = al + zeros[ah] - zeros[al], bl + zeros[bh] - zeros[bl]
        own = (al == bl) & (ah == bh)
        nodes = [
            np.stack([al, am, bl, bm, bits], axis=1),
            np.stack([am, ah, bm, bh, bits], axis=1),
            np.stack([al, am, bm, bh, bits + 1], axis=1),
            np.stack([am, ah, bl, bm, bits + 1], axis=1)[~own],
        ]
        frontier = np.concatenate(nodes)
        al, ah, bl, bh, bits = frontier.T
        frontier = frontier[(ah > al) & (bh > bl) & (bits <= max_bits)]
        depth += 1


def _leaf_pairs(values: np.ndarray, nodes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    al, ah, bl, bh, _ = nodes.T
    wide = bh - bl
    size = (ah - al) * wide
    of = np.repeat(np.arange(len(nodes)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    left, right = al[of] + place // wide[of], bl[of] + place % wide[of]
    near = np.bitwise_count(values[left] ^ values[right]) <= max_bits
    near &= (left < right) | ~((al == bl) & (ah == bh))[of]
    return left[near], right[near]


def _task_links(values: np.ndarray, order: np.ndarray, group: np.ndarray, side: np.ndarray, own: np.ndarray, all_orders, depth_of, max_bits: int):
    """A spanning forest of the links of whole groups: (fingerprint, smaller fingerprint of its tree)."""
    out = []
    for k in np.unique(order):
        here = order == k
        part, g, s, o = _reordered(values[here], all_orders[k]), group[here], side[here], own[here]
        place = np.lexsort((part, s, g))
        part, g, s, o = part[place], g[place], s[place], o[place]
        start = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
        end = np.r_[start[1:], len(part)]
        self_pairs = np.flatnonzero(o[start])
        cross = np.flatnonzero(~o[start][:-1] & ~o[start][1:] & (g[start][:-1] == g[start][1:])) if len(start) > 1 else np.empty(0, dtype=np.int64)
        frontier = np.concatenate([
            np.stack([start[self_pairs], end[self_pairs], start[self_pairs], end[self_pairs], np.zeros_like(self_pairs)], axis=1),
            np.stack([start[cross], end[cross], start[cross + 1], end[cross + 1], np.zeros_like(cross)], axis=1),
        ])
        label = np.arange(len(part))
        for left, right in trie_pairs(part, frontier, depth_of[k], max_bits):
            if len(left):
                label = forest(len(part), np.r_[np.arange(len(part)), left], np.r_[label, right])
        linked = np.flatnonzero(label != np.arange(len(part)))
        raw = values[here][place]
        out.append((raw[linked], raw[label[linked]]))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def links(prints: DataFrame, max_bits: int = 4, column: str = "_sim_print") -> DataFrame:
    """(a, b): links whose trees are those of all pairs of `prints` at most `max_bits` bits apart.

    `prints` has distinct fingerprints; it is read several times and should be a written table.
    """
    all_orders = orders(prints.count(), max_bits)
    depth_of = [sum(width for _, width in order[: len(order) - max_bits]) for order in all_orders]
    value = F.col(column)

    def leading(order: list[tuple[int, int]], m: int):
        code = F.lit(0).cast("bigint")
        for start, width in order[:m]:
            part = F.shiftrightunsigned(value, 64 - start - width).bitwiseAND(F.lit((1 << width) - 1))
            code = F.shiftleft(code, width).bitwiseOR(part.cast("bigint"))
        return code

    entries = F.array(*[F.struct(F.lit(k).alias("o"), leading(order, len(order) - max_bits).alias("g")) for k, order in enumerate(all_orders)])
    rows = prints.select(value.alias("p"), F.explode(entries).alias("e")).select("p", "e.o", "e.g")
    hot = rows.groupBy("o", "g").count().where(F.col("count") > GROUP_ROWS)
    hot = written(hot.select("o", "g", F.ceil(F.col("count") / GROUP_ROWS).cast("int").alias("tiles")), "hot_groups")
    if hot.isEmpty():
        dealt = rows.withColumn("tiles", F.lit(1))
    else:
        dealt = attach(rows, hot, ["o", "g"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("p"), F.col("tiles")).cast("int")
    dealt = dealt.withColumn("t", own).withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("o", "g", F.least("t", "u").alias("x"), F.greatest("t", "u").alias("y"), (F.col("t") > F.col("u")).cast("int").alias("side"), "p")
    keys = ["o", "g", "x", "y"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def flush(table: pa.Table) -> pa.RecordBatch:
            o, g, x, y, side, p = (table.column(i).to_numpy() for i in range(6))
            new = np.r_[True, (o[1:] != o[:-1]) | (g[1:] != g[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
            a, b = _task_links(p.view(np.uint64), o, np.cumsum(new), side, x == y, all_orders, depth_of, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < TASK_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            o, g, x, y = (table.column(i).to_numpy() for i in range(4))
            last = np.flatnonzero((o != o[-1]) | (g != g[-1]) | (x != x[-1]) | (y != y[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield flush(table.slice(0, cut).combine_chunks())
            held = table.slice(cut).to_batches()
            count = table.num_rows - cut
        if count:
            yield flush(pa.Table.from_batches(held).combine_chunks())

    return dealt.mapInArrow(joined, "a bigint, b bigint")


def _classes(printed: DataFrame, id: str, max_bits: int) -> DataFrame:
    """(_sim_print, _sim_root, component_id), written, for every fingerprint of the written rows."""
    prints = written(printed.groupBy("_sim_print").agg(F.min(F.col(f"`{id}`")).alias("_sim_least")), "simhash_distinct")
    roots = components(links(prints, max_bits)).select(F.col("node").alias("_sim_print"), F.col("root").alias("_sim_root"))
    placed = prints.join(roots, "_sim_print", "left").withColumn("_sim_root", F.coalesce("_sim_root", "_sim_print"))
    placed = written(placed, "simhash_placed")
    names = written(placed.groupBy("_sim_root").agg(F.min("_sim_least").alias("component_id")), "simhash_names")
    return written(placed.drop("_sim_least").join(names, "_sim_root"), "simhash_placed")


def simhash_components(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or only its columns `keep`, the id among them), `_sim_print`, `_sim_root`, `component_id`.

    `_sim_root` names the component by its smallest fingerprint; `component_id` is the
    smallest id of the component's rows. An earlier column `component_id` is replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != "component_id"]
    printed = written(with_fingerprints(docs, text, words, kept), "simhash_prints")
    return printed.join(_classes(printed, id, max_bits), "_sim_print")


def simhash_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component of near-duplicates: that of the smallest id; `docs`' columns.

    Null ids come last. Rows that repeat the smallest id: the smallest hash of the whole row
    stays, and one of rows that are equal throughout. The choice is made on narrow rows, of the
    id and 128 bits of hashes of the whole row, and these find the rows in `docs` again: no
    table of texts is written, and `docs` has to give the same rows whenever it is read.
    """
    whole, hashes = [F.col(f"`{c}`") for c in docs.columns], ["_sim_hash", "_sim_check"]
    # A hash passes over nulls, so the second one begins with where they are.
    check = F.xxhash64(*[c.isNull() for c in whole], *whole)
    rows = docs.select(*whole, F.xxhash64(*whole).alias("_sim_hash"), check.alias("_sim_check"))
    printed = written(with_fingerprints(rows, text, words, [id, *hashes]), "simhash_prints")
    key = F.col(f"`{id}`")
    narrow = printed.select("_sim_print", F.struct(key.isNull().alias("n"), key.alias("i"), *hashes).alias("rank"))
    ranked = narrow.join(_classes(printed, id, max_bits), "_sim_print").groupBy("_sim_root", "rank").agg(F.count("*").alias("copies"))
    ranked = ranked.groupBy("_sim_root").agg(F.min(F.struct("rank", "copies")).alias("first"))
    first = written(ranked.select(*[f"first.rank.{c}" for c in hashes], (F.col("first.copies") > 1).alias("_sim_equal")), "simhash_first")
    found = join_keyed(rows, first, hashes, "inner")
    if not first.where("_sim_equal").isEmpty():
        found = found.where("NOT _sim_equal").union(found.where("_sim_equal").dropDuplicates(hashes))
    return found.select(*whole)
