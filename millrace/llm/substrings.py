"""Substring dedup by seed and extend: words inside repeated passages are removed.

A passage is repeated if its word sequence, of `window` words or more, also starts anywhere
else, in the same document or another; all its occurrences are removed.

*Seeds.* Hashes of every SEED_WORDS consecutive words are winnowed: each window of `window`
words names its smallest one as its anchor, so equal windows name equal anchors. Windows
next to each other mostly name the same anchor; such a run, of at most
window - SEED_WORDS + 1 windows, is one row of the seed table. Anchors that occur once in the
corpus are dropped, by a count and a join on the anchor.

*Extension.* A seed extends to both sides as far as its run reaches. Where the same whole
extension occurs twice, all its windows are repeated. An extension that occurs once, beside
others of the same anchor, is compared window by window, shifted one word at a time, with
one representative of each: those at the ends of passages. Windows hit make a bit mask per
extension, and their union over a document's extensions are its maximal repeats.

No group of occurrences is ever brought together: copies are counted, with partial counts
before the shuffle, and joined back as (anchor, extension) classes from written tables, so
that adaptive execution can split hot ones. Hashes are compared as pairs of 64 bits.

Null texts have no words; texts under `window` words have no windows. Repeated rows, also of
one id, are occurrences like any other. Null ids are ids. Empty tables give no rows. Other
columns, whatever their names, are carried along; helper names start with `_sub`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.llm.joins import join_keyed
from millrace.llm.words import Sums, hashed, mix, utf8
from millrace.session import written

SEED_WORDS = 8
#: Windows of one run at most: they are the bits of one long. Wider windows have longer seeds.
MASK_BITS = 60
#: Words of one document that are winnowed at once.
CHUNK_WORDS = 1 << 22
_INDEX_BITS = np.uint64(23)

_SEEDS = Sums(0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5)
_RUNS = Sums(0x165667B19E3779F9, 0x85EBCA77C2B2AE63)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach, low = 1, values
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _runs(words: np.ndarray, cuts: np.ndarray, window: int):
    """Runs of windows with one anchor, in texts laid end to end (`cuts`: where texts end).

    Arrays: anchor hash, extension hash, index of the first window, number of windows.
    """
    none = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    seed_words = max(min(SEED_WORDS, window), window - MASK_BITS + 1)
    if len(words) < window:
        return none
    sums = _SEEDS.running(words)
    first = np.arange(len(words) - seed_words + 1)
    seeds = _SEEDS.of(sums, first, first + seed_words)
    ranked = (seeds & ~((np.uint64(1) << _INDEX_BITS) - np.uint64(1))) | first.astype(np.uint64)
    anchor = (_sliding_min(ranked, window - seed_words + 1) & ((np.uint64(1) << _INDEX_BITS) - np.uint64(1))).astype(np.int64)
    text_of = np.searchsorted(cuts, np.arange(len(anchor)), side="right")
    inside = cuts[text_of] >= np.arange(len(anchor)) + window
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (text_of[1:] != text_of[:-1])] & inside
    start = np.flatnonzero(new)
    if not len(start):
        return none
    counted = np.cumsum(inside)
    edge = np.r_[counted[start[1:]] - 1, counted[-1]]
    number = edge - (counted[start] - 1)
    at = anchor[start]
    run_sums = _RUNS.running(words)
    whole = _RUNS.of(run_sums, start, start + number + window - 1)
    shape = ((at - start) * 64 + number).astype(np.uint64)
    return seeds[at], mix(whole ^ mix(shape + np.uint64(1))), start, number


def _texts_runs(texts: list[bytes], window: int):
    """Per slice of texts: (row index, first window in its text, anchor, extension, windows)."""
    for at, slices in hashed(texts):
        if len(slices) == 1:
            words = slices[0]
            for chunk in range(0, max(1, len(words) - window + 1), CHUNK_WORDS):
                part = words[chunk : chunk + CHUNK_WORDS + window - 1]
                anchor, whole, start, number = _runs(part, np.array([len(part)]), window)
                yield np.full(len(start), at), start + chunk, anchor, whole, number
            continue
        lengths = np.array([len(s) for s in slices])
        ends = np.cumsum(lengths)
        anchor, whole, start, number = _runs(np.concatenate(slices), ends, window)
        of = np.searchsorted(ends, start, side="right")
        yield at + of, start - (ends - lengths)[of], anchor, whole, number


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def seeds(docs: DataFrame, window: int) -> DataFrame:
    """(_sub_id, _sub_hash, anchor, whole, start, windows) for every run of every text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, start, anchor, whole, number in _texts_runs(utf8(batch.column(2)), window):
                rows = pa.array(of)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), batch.column(1).take(rows), _signed(anchor), _signed(whole),
                    pa.array(start.astype(np.int64)), pa.array(number.astype(np.int32)),
                ], names=["_sub_id", "_sub_hash", "anchor", "whole", "start", "windows"])

    schema = StructType(docs.select("_sub_id", "_sub_hash").schema.fields)
    for name, kind in (("anchor", "long"), ("whole", "long"), ("start", "long"), ("windows", "integer")):
        schema = schema.add(name, kind)
    return docs.select("_sub_id", "_sub_hash", "_sub_text").mapInArrow(found, schema)


def _windows(docs: DataFrame, picked: DataFrame, window: int) -> DataFrame:
    """(anchor, whole, place, content) for every window of the picked runs."""
    per_text = written(
        picked.groupBy("_sub_id", "_sub_hash").agg(F.collect_set(F.struct("anchor", "whole", "start", "windows")).alias("runs")),
        "substring_contested",
    )
    texts = join_keyed(docs.select("_sub_id", "_sub_hash", "_sub_text"), per_text, ["_sub_id", "_sub_hash"], "inner", limit=0)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts = batch.column(1), utf8(batch.column(0))
            offsets, items = runs.offsets.to_numpy() - runs.offsets[0].as_py(), runs.flatten()
            anchor, whole, start, number = (items.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            for at, slices in hashed(texts):
                lengths = np.array([len(s) for s in slices])
                base = np.repeat(np.cumsum(lengths) - lengths, np.diff(offsets[at : at + len(slices) + 1]))
                low, high = offsets[at], offsets[at + len(slices)]
                n = number[low:high].astype(np.int64)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                first = np.repeat(base + start[low:high], n) + place
                words = np.concatenate(slices)
                content = _RUNS.of(_RUNS.running(words), first, first + window)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(anchor[low:high], n)), pa.array(np.repeat(whole[low:high], n)),
                    pa.array(place.astype(np.int32)), _signed(content),
                ], names=["anchor", "whole", "place", "content"])

    return texts.select("_sub_text", "runs").mapInArrow(spread, "anchor bigint, whole bigint, place int, content bigint")


def repeats(docs: DataFrame, window: int) -> DataFrame:
    """(_sub_id, _sub_hash, hits): per text with repeated windows, [(first window of a run, bit mask)]."""
    runs = written(seeds(docs, window), "substring_runs")
    common = written(runs.groupBy("anchor").count().where("count > 1").select("anchor"), "substring_anchors")
    found = written(runs.join(common, "anchor"), "substring_seeds")
    at = F.struct("_sub_id", "_sub_hash", "start", "windows")
    classes = written(
        found.groupBy("anchor", "whole").agg(F.count("*").alias("copies"), F.min(at).alias("at")), "substring_classes"
    )
    open_anchors = written(classes.where("copies = 1").select("anchor").distinct(), "substring_open")
    picked = classes.join(open_anchors, "anchor").select("anchor", "whole", "at.*")
    windows = written(_windows(docs, picked, window), "substring_windows")
    twice = written(windows.groupBy("anchor", "content").count().where("count > 1").drop("count"), "substring_twice")
    bit = F.expr("shiftleft(1L, place)")
    partly = windows.join(twice, ["anchor", "content"]).groupBy("anchor", "whole").agg(F.bit_or(bit).alias("hit"))
    every = F.expr("shiftleft(1L, at.windows) - 1")
    masks = classes.select("anchor", "whole", F.when(F.col("copies") > 1, every).alias("all")).join(partly, ["anchor", "whole"], "left")
    masks = written(masks.select("anchor", "whole", F.coalesce("all", "hit").alias("hit")).where("hit IS NOT NULL"), "substring_masks")
    hits = found.join(masks, ["anchor", "whole"])
    return written(
        hits.groupBy("_sub_id", "_sub_hash").agg(F.collect_set(F.struct("start", "hit")).alias("_sub_hits")), "substring_hits"
    )


def removed_words(words: int, hits, window: int) -> np.ndarray:
    """Which words of a text are covered, from its hits (first window of a run, bit mask)."""
    steps = np.zeros(words + 1, dtype=np.int64)
    for start, mask in hits:
        for place in range(64):
            if mask >> place & 1:
                steps[start + place] += 1
                steps[start + place + window] -= 1
    return np.cumsum(steps[:-1]) > 0


def substring_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 35, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or only its columns `keep`) with `_sub_kept`, `_sub_words`, `_sub_removed`.

    `_sub_kept`: the words that stay, joined by one space; `_sub_words`: how many the text
    had; `_sub_removed`: how many of them lie in repeated passages.
    """
    if window < 1:
        raise ValueError("a window has one word at least")
    kept = docs.columns if keep is None else keep
    body = F.col(f"`{text}`")
    known = [F.col(f"`{id}`").alias("_sub_id"), F.xxhash64(body).alias("_sub_hash")]
    own = text if text in kept else "_sub_text"  # carried once
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], *known, *([] if own == text else [body.alias(own)]))
    hits = repeats(docs.select(*known, body.alias("_sub_text")), window)
    joined = join_keyed(rows, hits, ["_sub_id", "_sub_hash"], "left", limit=0).drop("_sub_id", "_sub_hash")
    fields = [f for f in joined.schema.fields if f.name in kept]
    schema = StructType([*fields, StructField("_sub_kept", StringType())]).add("_sub_words", "long").add("_sub_removed", "long")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, words, gone = [], [], []
            for body, hits in zip(utf8(batch.column(own)), batch.column("_sub_hits").to_pylist()):
                parts = body.split()
                out = removed_words(len(parts), [(h["start"], h["hit"]) for h in hits], window) if hits else None
                stay = parts if out is None else [parts[i] for i in np.flatnonzero(~out)]
                left.append(b" ".join(stay))
                words.append(len(parts))
                gone.append(len(parts) - len(stay))
            yield pa.RecordBatch.from_arrays([
                *[batch.column(f.name) for f in fields],
                pa.array(left, pa.binary()).cast(pa.string()), pa.array(words, pa.int64()), pa.array(gone, pa.int64()),
            ], names=schema.names)

    return joined.mapInArrow(cleaned, schema)
