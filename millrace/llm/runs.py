"""Periodic runs of words, found by string synchronising sets at dyadic scales.

A run is a stretch of words with smallest period q (words q apart are identical) and at least
`repeats` * q words, 4 or more repeats, that no neighbouring word extends.

At scale t = 1, 2, 4, ... every position has the hash of its next t words, and is chosen if this
is the least among the hashes of the positions from it, or the one t after it, to t apart. This
depends on the next 2t words alone (the context), so that equal contexts are chosen alike, and of
any q >= t positions in a row of a run one is chosen at least. A run with t <= q < 2t therefore
holds chosen positions whose next equal context is exactly q away: each such pair proposes its
distance as a period. Pairs of one distance whose contexts meet are put together, extended to
both sides word by word, and checked over the whole stretch. Where they could be extended by 2t
words, the stretch has a smaller period too, and another scale finds it.

Positions whose t words have a period of t / 4 or less are never chosen; their regions are the
runs found at the scales before, which supply those periods. So a scale chooses some 2 n / t of
n positions, and all scales together take O(n log n) steps for any text.

Words are compared by exact codes, and hashes of t words by 64 bits: equal words are never
missed, and every run is checked on the codes. Documents are handled in slices of some
megabytes of text, a longer document by itself; none is cut.

Null texts, and texts without words, have no runs and no words. Null and repeated ids are rows
like others; empty tables give no rows. Columns other than the text are carried along; helper
names start with `_run`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from millrace.llm.words import SLICE_BYTES, SPACE, mix, utf8

#: Repeats of a run that the search of this module needs at least.
LEAST_REPEATS = 4
_RUN = StructType().add("start", "long").add("length", "long").add("period", "long")
_NEVER = np.uint64(2**64 - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words compared at once when pairs are extended.
_BLOCK = 1 << 20


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + _STEP) ^ b)


def runs(codes: np.ndarray, first: np.ndarray, repeats: int = LEAST_REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of documents, by start and period.

    Document k's words are `codes[first[k]:first[k + 1]]`: whole numbers of at least 0.
    """
    if repeats < LEAST_REPEATS:
        raise ValueError(f"runs of fewer than {LEAST_REPEATS} repeats are not found")
    size = np.diff(first)
    # A word of its own after every document, so that nothing reaches into the next.
    doc = np.repeat(np.arange(len(size)), size + 1)
    last = np.cumsum(size + 1) - 1
    words = np.empty(len(doc), dtype=np.int64)
    inner = np.ones(len(doc), dtype=bool)
    inner[last] = False
    words[inner], words[last] = codes, -1 - np.arange(len(size))
    found = np.empty((0, 3), dtype=np.int64)
    place, hashes, t = np.arange(len(words)), mix(words.astype(np.uint64)), 1
    while len(words) and (long := size >= LEAST_REPEATS * t).any():
        if t == 1 or not long[doc[place]].all():
            kept = long[doc[place]]
            # `place` has every word still looked at; hashes end where too few words follow.
            hashes = hashes[kept[: len(hashes)]]
            place = place[kept]
        here = words[place]
        context = _joined(hashes[:-t], hashes[t:])
        chosen = _chosen(hashes, len(context), t, place, found)
        new = _repeats(here, chosen, context[chosen], t)
        if len(new):
            new[:, 0] = place[new[:, 0]]
            found = np.concatenate([found, new])
        hashes, t = context, 2 * t
    found = found[found[:, 1] >= repeats * found[:, 2]]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 0] - doc[found[:, 0]] if len(found) else found[:, 0], found[:, 1], found[:, 2]


def _chosen(hashes: np.ndarray, count: int, t: int, place: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set among the first `count`."""
    small = found[(4 * found[:, 2] <= t) & (found[:, 1] >= t)]
    own = hashes
    if len(small):
        begin = np.searchsorted(place, small[:, 0])
        edge = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(edge, np.minimum(begin, len(hashes)), 1)
        np.add.at(edge, np.minimum(begin + small[:, 1] - t + 1, len(hashes)), -1)
        own = np.where(np.cumsum(edge[:-1]) > 0, _NEVER, hashes)
    least, width = own, 1
    while width < t:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:count], least[1 : count + 1])
    return np.flatnonzero(((own[:count] == least) | (own[t : t + count] == least)) & (least != _NEVER))


def _repeats(words: np.ndarray, chosen: np.ndarray, context: np.ndarray, t: int) -> np.ndarray:
    """(start, length, period) of the runs of periods from t up to 2t, in places of `words`."""
    meet = 2 * t
    if t == 1:
        at, meet = np.flatnonzero(words[:-1] == words[1:]), 1
        period = np.ones_like(at)
    else:
        order = np.argsort(context, kind="stable")
        at, same = chosen[order], context[order]
        period = np.diff(at)
        near = np.flatnonzero((same[:-1] == same[1:]) & (period >= t) & (period < 2 * t))
        at, period = at[near], period[near]
    if not len(at):
        return np.empty((0, 3), dtype=np.int64)
    # Words from `at` to `end` equal those a period later; stretches of one period that meet are one.
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.flatnonzero(np.r_[True, (period[1:] != period[:-1]) | (at[1:] > at[:-1] + meet)])
    begin, period, end = at[new], period[new], at[np.r_[new[1:] - 1, len(at) - 1]] + meet
    left, right = _extended(words, begin - 1, period, -1, 2 * t), _extended(words, end, period, 1, 2 * t)
    whole = (left < 2 * t) & (right < 2 * t)
    begin, end, period = (begin - left)[whole], (end + right)[whole], period[whole]
    length = end + period - begin
    often = length >= LEAST_REPEATS * period
    out = np.unique(np.stack([begin[often], length[often], period[often]], axis=1), axis=0)
    return out[[_holds(words, *run) for run in out.tolist()]] if len(out) else out


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words from `at` on (by `step`) equal those a period later, up to `most`."""
    out = np.empty(len(at), dtype=np.int64)
    ahead = step * np.arange(most)
    rows = max(1, _BLOCK // most)
    for k in range(0, len(at), rows):
        x = at[k : k + rows, None] + ahead
        y = x + period[k : k + rows, None]
        inside = (x >= 0) & (y < len(words))
        unlike = ~inside | (words[np.where(inside, x, 0)] != words[np.where(inside, y, 0)])
        out[k : k + rows] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), most)
    return out


def _holds(words: np.ndarray, start: int, length: int, period: int) -> bool:
    return bool((words[start : start + length - period] == words[start + period : start + length]).all())


class Words:
    """The words of texts: their bytes with a blank after each, and where each begins."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        solid = ~SPACE[data]
        after = np.r_[False, solid[:-1]] & ~solid  # the first blank behind a word
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.flat = data[solid | after]
        blank = SPACE[self.flat]
        self.flat[blank] = 0x20
        self.offset = np.r_[0, np.flatnonzero(blank) + 1]
        #: Number of words before each text, and of all.
        self.first = np.r_[0, np.searchsorted(np.flatnonzero(after), ends)]

    def encoded(self) -> pa.DictionaryArray:
        """The words, each with its blank."""
        parts = [None, pa.py_buffer(self.offset.astype(np.int64)), pa.py_buffer(self.flat)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.offset) - 1, parts).dictionary_encode()

    def codes(self) -> np.ndarray:
        """Numbers that are equal if words are."""
        return self.encoded().indices.to_numpy().astype(np.int64)

    def kept(self, keep: np.ndarray) -> list[bytes]:
        """Each text's words of `keep`, joined by a blank."""
        out = []
        for a, b in zip(self.first[:-1], self.first[1:]):
            flat = self.flat[self.offset[a] : self.offset[b]]
            if not keep[a:b].all():
                flat = flat[np.repeat(keep[a:b], np.diff(self.offset[a : b + 1]))]
            out.append(flat[:-1].tobytes())
        return out


def slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    at = 0
    while at < len(texts):
        size, end = len(texts[at]), at + 1
        while end < len(texts) and size + len(texts[end]) <= SLICE_BYTES:
            size, end = size + len(texts[end]), end + 1
        yield texts[at:end]
        at = end


def _found(texts: list[bytes], least: int, repeats: int) -> tuple[list[tuple], np.ndarray, list[bytes]]:
    """Per text its runs (as arrays start, length, period), and its words outside of repeats."""
    words = Words(texts)
    start, length, period = runs(words.codes(), words.first, repeats)
    long = length >= least
    start, length, period = start[long], length[long], period[long]
    edge = np.zeros(words.first[-1] + 1, dtype=np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    kept = words.kept(np.cumsum(edge[:-1]) == 0)
    cuts = np.searchsorted(start, words.first)
    return (start - np.repeat(words.first[:-1], np.diff(cuts)), length, period), np.diff(cuts), kept


def periodic_runs(docs: DataFrame, text: str = "text", least: int = 6, repeats: int = LEAST_REPEATS, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or only its columns `keep`) with `_run_found` and `_run_kept`.

    `_run_found`: the runs of `least` words and `repeats` periods or more, as (start, length,
    period) by start and period, in words. `_run_kept`: the words that are in no run behind its
    first period, joined by a blank.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if not c.startswith("_run")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_run_text"))
    schema = StructType([f for f in rows.schema.fields if f.name in kept])
    schema = schema.add("_run_found", ArrayType(_RUN)).add("_run_kept", "string")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = utf8(batch.column("_run_text")), 0
            for part in slices(texts):
                columns, count, left = _found(part, least, repeats)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(count)], pa.int32()),
                    pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["start", "length", "period"]),
                )
                rest = pa.array(left, pa.binary()).cast(pa.string())
                own = batch.slice(at, len(part))
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in kept], lists, rest], names=schema.names)
                at += len(part)

    return rows.mapInArrow(step, schema)
