"""Best-fit packing of token sequences, with large-item matching.

*Plan.* Where an item goes depends on its length only, so the plan is made on the histogram
of lengths, whose size is bounded by the capacity. Items above a third of the capacity come
at most two to a sequence: from the longest down, each is matched with the longest other
large item that fits, which gives as few sequences as any matching of these. The smaller
items, longest first, go to the sequence with the smallest gap they fit in, and to a new one
if there is none. Equal items are placed as one step, so the plan is a short list of slots.

*Placement.* The items of each length are numbered from 0: counted by (length, chunk of
rows), summed along the chunks, and numbered inside each. Any length may be hot, since its
rows are spread over many chunks. The number picks the slot from the plan, which is sent to
all tasks; its size is bounded by the capacity too.

*Documents.* A document is its token ids and an end id. Only longer ones than the capacity
are cut, into pieces of the capacity; the last piece may be shorter.

Null texts are empty (the end id alone). Repeated rows are documents of their own. Items
without a length, or of none, get no sequence (null); an item above the capacity is an
error. Empty tables give no rows. Other columns are carried along; helper names start with
`_pack`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.tokens import encoded, id_type
from millrace.session import written

#: Rows of a chunk, of all lengths together, and the least number of chunks.
CHUNK_ROWS = 1 << 20
LEAST_CHUNKS = 64


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, text: str = "text", keep: list[str] | None = None, id_bits: int = 32, remembered: int | None = None) -> DataFrame:
    """`docs`' columns, or only `keep`, with `piece`, `start`, `length` and `ids` (unsigned, little-endian).

    `id_bits` of 16 halves the ids, for vocabularies that fit. `remembered`: pieces of text
    that a worker remembers the ids of, for tasks that have less memory. Columns of `docs` with one of
    those names are replaced.
    """
    if id_bits not in (16, 32) or id_bits == 16 and id_type(tokenizer).itemsize > 2:
        raise ValueError(f"ids of this vocabulary have no {id_bits} bits")
    kind = f"<u{id_bits // 8}"
    own = ("piece", "start", "length", "ids")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in own]
    chosen = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_pack_text"))
    schema = StructType(chosen.drop("_pack_text").schema.fields)
    schema = schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids", "binary")
    end = np.array([end_id], dtype=np.uint32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_pack_text")
            for low in range(0, batch.num_rows, 2048):
                rows, piece, start, length, ids = [], [], [], [], []
                for row, tokens in enumerate(encoded(texts.slice(low, 2048), tokenizer, remembered), low):
                    tokens = np.concatenate([tokens, end]).astype(kind)
                    for number, at in enumerate(range(0, len(tokens), capacity)):
                        part = tokens[at : at + capacity]
                        rows.append(row), piece.append(number), start.append(at), length.append(len(part)), ids.append(part.tobytes())
                taken = [batch.column(c).take(pa.array(rows)) for c in kept]
                yield pa.RecordBatch.from_arrays([
                    *taken, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                ], names=schema.names)

    return chosen.mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Slots (length, first number, last number + 1, items per sequence, first sequence, offset), and how many sequences."""
    left = np.zeros(capacity + 1, dtype=object)
    for length, count in counts.items():
        left[length] = count
    slots: list[tuple[int, ...]] = []
    given = [0] * (capacity + 1)
    sequences = 0
    by_gap: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: runs (first sequence, how many)

    def place(length: int, per: int, first: int, many: int, offset: int) -> None:
        slots.append((length, given[length], given[length] + per * many, per, first, offset))
        given[length] += per * many
        left[length] -= per * many

    def opened(many: int, used: int) -> int:
        nonlocal sequences
        sequences += many
        by_gap[capacity - used].append((sequences - many, many))
        return sequences - many

    large = capacity // 3 + 1
    for length in range(capacity, large - 1, -1):
        partner = min(length, capacity - length)
        while left[length]:
            while partner >= large and left[partner] < (2 if partner == length else 1):
                partner -= 1
            if partner < large:
                many = left[length]
                place(length, 1, opened(many, length), many, 0)
            elif partner == length:
                many = left[length] // 2
                place(length, 2, opened(many, 2 * length), many, 0)
            else:
                many = min(left[length], left[partner])
                first = opened(many, length + partner)
                place(length, 1, first, many, 0)
                place(partner, 1, first, many, length)
    for length in range(large - 1, 0, -1):
        gap = length - 1
        while left[length]:
            gap = min((g for g in by_gap if g > gap), default=capacity + 1) if gap < capacity else capacity + 1
            if gap > capacity:
                per = capacity // length
                many, rest = divmod(left[length], per)
                if many:
                    place(length, per, opened(many, per * length), many, 0)
                if rest:
                    place(length, rest, opened(1, rest * length), 1, 0)
                break
            per, runs = gap // length, by_gap.pop(gap)
            while runs and left[length]:
                first, many = runs.pop()
                full = min(many, left[length] // per)
                if full:
                    place(length, per, first, full, capacity - gap)
                    by_gap[gap - per * length].append((first, full))
                    first, many = first + full, many - full
                if many and (rest := min(left[length], per - 1)):
                    place(length, rest, first, 1, capacity - gap)
                    by_gap[gap - rest * length].append((first, 1))
                    first, many = first + 1, many - 1
                if many:
                    runs.append((first, many))
                    if not left[length]:
                        break
            if runs:
                by_gap[gap].extend(runs)
    slots.sort()
    return np.array(slots, dtype=np.int64).reshape(-1, 6), sequences


def pack(items: DataFrame, capacity: int = 2048, length: str = "length") -> DataFrame:
    """`items` with `sequence_id` and `offset`: as few sequences as best fit gives, gapless from offset 0."""
    rows = items.drop("sequence_id", "offset").withColumn("_pack_row", F.monotonically_increasing_id())
    rows = written(rows, "pack_items")
    size = F.col(f"`{length}`").cast("long")
    chunks = max(LEAST_CHUNKS, rows.count() // CHUNK_ROWS)
    keyed = rows.withColumn("_pack_length", size).withColumn("_pack_chunk", F.pmod(F.xxhash64("_pack_row"), F.lit(chunks)))
    counts = written(keyed.groupBy("_pack_length", "_pack_chunk").count(), "pack_counts")
    lengths = counts.where("_pack_length > 0").groupBy("_pack_length").agg(F.sum("count").alias("n"))
    too_long = lengths.where(F.col("_pack_length") > capacity).limit(1).collect()
    if too_long:
        raise ValueError(f"an item of {too_long[0][0]} tokens is longer than {capacity}")
    slots, _ = plan({r[0]: r[1] for r in lengths.collect()}, capacity)
    along = Window.partitionBy("_pack_length").orderBy("_pack_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_pack_length", "_pack_chunk", F.coalesce(F.sum("count").over(along), F.lit(0)).alias("_pack_before"))
    inside = Window.partitionBy("_pack_length", "_pack_chunk").orderBy("_pack_row")
    numbered = keyed.withColumn("_pack_number", F.row_number().over(inside) - 1)
    numbered = numbered.join(before, ["_pack_length", "_pack_chunk"], "left")
    numbered = numbered.select(
        *[F.col(f"`{c}`") for c in items.columns if c not in ("sequence_id", "offset")],
        F.col("_pack_length"), (F.col("_pack_number") + F.col("_pack_before")).alias("_pack_number"),
    )
    kept = numbered.columns[:-2]
    schema = StructType(numbered.drop("_pack_length", "_pack_number").schema.fields).add("sequence_id", "long").add("offset", "long")
    broadcast = items.sparkSession.sparkContext.broadcast(slots)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = broadcast.value
        starts = np.searchsorted(table[:, 0], np.arange(capacity + 2))
        for batch in batches:
            size = batch.column("_pack_length").fill_null(0).to_numpy()
            number = batch.column("_pack_number").fill_null(0).to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for one in np.unique(size[size > 0]):
                here = np.flatnonzero(size == one)
                part = table[starts[one] : starts[one + 1]]
                slot = part[np.searchsorted(part[:, 1], number[here], side="right") - 1]
                place = number[here] - slot[:, 1]
                sequence[here] = slot[:, 4] + place // slot[:, 3]
                offset[here] = slot[:, 5] + place % slot[:, 3] * one
            none = size <= 0
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sequence, mask=none), pa.array(offset, mask=none)], names=schema.names
            )

    return numbered.mapInArrow(placed, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, text: str = "text", keep: list[str] | None = None, id_bits: int = 32, remembered: int | None = None) -> DataFrame:
    """The pieces of `docs`, with their ids, each with its `sequence_id` and `offset`."""
    return pack(pieces(docs, tokenizer, capacity, end_id, text, keep, id_bits, remembered), capacity)
