"""Merging cleaned files on the record key, or stacking them.

The merge is a fold of null-safe equi-joins in file order; a column belongs to the first
file that has it, later files' values for it are dropped, not coalesced. Three facts
make it cheap for many files:

* A file that owns no column only decides which keys exist and how often a row repeats.
  All such files together are one count per key.
* Every other file owns at least one column, so there are at most as many joins as
  columns.
* If no file repeats a key, the whole outer or inner fold is one aggregation by key.

A key may hold a third of a file, on both sides. A key is hot if a task that had it alone
would write more than `Skew.task_rows` rows. Its rows are dealt to a grid of join keys: the
left rows to rows of the grid, the right rows to its columns, each copied along its own, so
that no cell makes more than that many. A step is cut to a few cells per task at most: a task
makes its share of all rows anyway, and finer cells would only be more copies, which then grow
as the rows made and no longer as the rows read. Hot keys stay in a table, however many there are.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import DUPLICATE_SUFFIX, KEY
from millrace.operators.attach import attach
from millrace.session import size_shuffles, stream_outer_joins, written

# Rows that one key may make in one task of a join.
TASK_ROWS = 1_000_000
# Cells that all rows of a step are cut to at most: these, or so many per task of its shuffle.
CELLS = 1024
CELLS_PER_TASK = 4
# Rows of one side of a hot key that a cell may have, since a full outer join holds them.
SIDE_ROWS = 100_000
# Rows one joined row may be repeated into by a single task.
REPEAT_ROWS = 100_000

log = logging.getLogger(__name__)

NUMERIC_ORDER = ("tinyint", "smallint", "int", "bigint", "float", "double")


@dataclass(frozen=True)
class Skew:
    """Rows that one key may make in one task; beyond that its rows are dealt to several.

    More if a merge makes so many that its tasks can't help it (`CELLS`).
    """

    task_rows: int = TASK_ROWS


def own_columns(schemas: Sequence[Sequence[str]], key: str = KEY) -> list[list[str]]:
    """Per file the columns it is the first to have; `_dup` columns never survive a merge."""
    taken: set[str] = {key}
    owned = []
    for columns in schemas:
        fresh = [c for c in columns if c not in taken]
        taken.update(fresh)
        owned.append([c for c in fresh if not c.endswith(DUPLICATE_SUFFIX)])
    return owned


def merge_pair(
    left: DataFrame,
    right: DataFrame,
    how: str = "outer",
    key: str = KEY,
    skew: Skew = Skew(),
) -> DataFrame:
    """Null-safe join of two frames on `key`; the left frame's columns win."""
    return merge_frames([left, right], how, key, skew)


@dataclass(frozen=True)
class KeyCounts:
    """What a merge needs to know of its keys before it starts."""

    most_per_key: float
    hot: list[DataFrame | None]  # per join step: key, _rows and _columns of its grid, _both
    result_rows: float
    null_key_rows: float


def count_keys(
    frames: Sequence[DataFrame],
    how: str = "outer",
    key: str = KEY,
    skew: Skew = Skew(),
    repeats: DataFrame | None = None,
) -> KeyCounts:
    """Count every key in every frame, in one aggregation over the keys alone.

    Joining frame i to the frames before it meets, per key, the product of their counts
    on the left and its own count on the right; a key is hot if that makes more than
    `skew.task_rows` rows, and more than a cell's share of all that the step makes, or if one
    of its sides is too long for a cell. `repeats` holds one row (key, _times) per key for the
    last step, standing for `_times` rows.
    """
    one = F.lit(1.0).alias("weight")
    parts = [
        f.select(F.col(key).alias("key"), F.lit(i).alias("file"), one) for i, f in enumerate(frames)
    ]
    steps = len(frames) + (repeats is not None)
    if repeats is not None:
        parts.append(repeats.select(
            F.col(key).alias("key"), F.lit(steps - 1).alias("file"), F.col("_times").alias("weight")))
    per_key = reduce(DataFrame.union, parts).groupBy("key").agg(*[
        F.coalesce(F.sum(F.when(F.col("file") == i, F.col("weight"))), F.lit(0.0)).alias(f"n{i}")
        for i in range(steps)
    ])

    def product(upto: int) -> Column:
        return reduce(lambda a, b: a * b, [F.greatest(F.col(f"n{j}"), F.lit(1.0)) for j in range(upto)])

    sides = {}
    for i in range(1, steps):
        present = reduce(lambda a, b: a | b, [F.col(f"n{j}") > 0 for j in range(i)])
        sides[f"left{i}"] = F.when(present, product(i)).otherwise(0.0)
        pieces = repeats is not None and i == steps - 1
        sides[f"right{i}"] = F.ceil(F.col(f"n{i}") / REPEAT_ROWS).cast("double") if pieces else F.col(f"n{i}")
    if how == "outer":
        result = product(steps)
    else:
        result = reduce(lambda a, b: a * b, [F.col(f"n{j}") for j in range(steps)])
    made = {}
    for i in range(1, steps):
        met = F.greatest(F.col(f"left{i}"), F.lit(1.0)) * F.greatest(F.col(f"n{i}"), F.lit(1.0))
        alone = (F.col(f"left{i}") == 0) | (F.col(f"n{i}") == 0)
        made[f"made{i}"] = F.when(alone & F.lit(how == "inner"), 0.0).otherwise(met)
    counts = per_key.select("key", *[f"n{i}" for i in range(steps)], *[c.alias(name) for name, c in sides.items()], result.alias("rows"))
    counts = counts.select("*", *[c.alias(name) for name, c in made.items()])
    names = ["n0", *sides, *made]
    totals = counts.agg(
        *[F.max(n).alias(f"max_{n}") for n in names],
        *[F.sum(n).alias(f"sum_{n}") for n in made],
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("key").isNull(), F.col("rows"))).alias("null_rows"),
    ).first()
    cells = max(CELLS, CELLS_PER_TASK * size_shuffles(counts.sparkSession, 0))
    hot = []
    for i in range(1, steps):
        most, cell_rows = totals[f"max_made{i}"] or 0, max(skew.task_rows, (totals[f"sum_made{i}"] or 0) / cells)
        long = max(totals[f"max_left{i}"] or 0, totals[f"max_right{i}"] or 0) > SIDE_ROWS
        hot.append(
            written(_grids(counts, f"left{i}", f"right{i}", f"made{i}", key, skew.task_rows, cell_rows), "hot_keys")
            if most > cell_rows or long and most > skew.task_rows else None)
    own = ["n0", *[f"right{i}" for i in range(1, steps)]]
    return KeyCounts(
        max(totals[f"max_{n}"] or 0 for n in own), hot, totals["rows"] or 0.0, totals["null_rows"] or 0.0)


def _grids(
    counts: DataFrame, left: str, right: str, made: str, key: str, task_rows: int, cell_rows: float
) -> DataFrame:
    """(key, _rows, _columns, _both) of the hot keys: the grid its left and right rows are dealt to.

    As square as the sides allow, since left rows are copied to all columns and right rows
    to all rows of the grid, but no cell has more than `SIDE_ROWS` of a side.
    """
    l, r = (F.greatest(F.col(c), F.lit(1.0)) for c in (left, right))
    hot = (F.col(made) > task_rows) & ((F.col(made) > cell_rows) | (F.greatest(l, r) > SIDE_ROWS))
    tables = counts.filter(hot).withColumn("cells", F.ceil(F.col(made) / cell_rows).cast("double"))
    square = F.least(r, F.greatest(F.lit(1.0), F.ceil(F.sqrt(F.col("cells") * r / l)).cast("double")))
    tables = tables.withColumn("_rows", F.least(l, F.ceil(F.col("cells") / square).cast("double")))
    tables = tables.withColumn("_columns", F.least(r, F.ceil(F.col("cells") / F.col("_rows")).cast("double")))
    tables = tables.withColumns({
        "_rows": F.greatest("_rows", F.ceil(l / SIDE_ROWS).cast("double")),
        "_columns": F.greatest("_columns", F.ceil(r / SIDE_ROWS).cast("double")),
    })
    return tables.select(
        F.col("key").alias(key), F.col("_rows").cast("int"), F.col("_columns").cast("int"),
        ((F.col(left) > 0) & (F.col(right) > 0)).alias("_both"),
    )


def _join(left: DataFrame, right: DataFrame, how: str, key: str, hot: DataFrame | None) -> DataFrame:
    how = {"outer": "full_outer", "inner": "inner"}[how]
    if hot is None:
        return _plain_join(left, right, how, key, [])
    if how == "full_outer":
        # A cell may make far more rows than a task can hold.
        stream_outer_joins(left.sparkSession)

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        place = F.xxhash64(*[side[f"`{c}`"] for c in side.columns]) + F.spark_partition_id()
        marked = attach(side.withColumn("_place", place), hot, [key], "left")
        mine = F.pmod(F.col("_place"), F.col(own)).cast("int")
        along = F.sequence(F.lit(0), F.col(other) - 1)
        if own == "_rows":
            cells = F.transform(along, lambda j: mine * F.col("_columns") + j)
        else:
            cells = F.transform(along, lambda i: i * F.col("_columns") + mine)
        # A key of one side meets nothing, so its rows are dealt without copies.
        cells = F.when(F.col("_both").isNull(), F.array(F.lit(0))).when(F.col("_both"), cells).otherwise(F.array(mine))
        return marked.withColumn("_salt", F.explode(cells)).drop("_place", "_rows", "_columns")

    left = dealt(left, "_rows", "_columns").withColumnRenamed("_both", "_left_both")
    right = dealt(right, "_columns", "_rows").withColumnRenamed("_both", "_right_both")
    return _plain_join(left, right, how, key, ["_salt"])


def _plain_join(left: DataFrame, right: DataFrame, how: str, key: str, salts: list[str]) -> DataFrame:
    left = left.withColumn("_in_left", F.lit(True))
    right = right.withColumn("_in_right", F.lit(True)).withColumnsRenamed(
        {key: "_right_key", **{s: f"_right{s}" for s in salts}}
    )
    match = left[key].eqNullSafe(right["_right_key"])
    for s in salts:
        match = match & (left[s] == right[f"_right{s}"])
    joined = left.join(right, match, how)
    if salts:
        # A copy of a row whose key is on both sides but not under this salt is no row.
        spare = (F.col("_left_both") & F.col("_in_right").isNull()) | (
            F.col("_right_both") & F.col("_in_left").isNull()
        )
        joined = joined.filter(~F.coalesce(spare, F.lit(False)))
    out = F.when(F.col("_in_left"), F.col(key)).otherwise(F.col("_right_key")).alias(key)
    hidden = {key, "_in_left", "_in_right", "_right_key", "_left_both", "_right_both",
              *salts, *[f"_right{s}" for s in salts]}
    columns = [out if c == key else F.col(f"`{c}`") for c in left.columns if c == key or c not in hidden]
    return joined.select(*columns, *[F.col(f"`{c}`") for c in right.columns if c not in hidden])


def merge_frames(
    frames: Sequence[DataFrame],
    how: str = "outer",
    key: str = KEY,
    skew: Skew = Skew(),
    null_keys: str = "match",
    max_result_rows: int | None = None,
) -> DataFrame:
    """Fold frames in order: `outer` keeps all records, `inner` the matching ones."""
    if len(frames) == 1:
        return frames[0]
    owned = own_columns([f.columns for f in frames], key)
    first = frames[0].select(*[
        c for c in frames[0].columns if not c.endswith(DUPLICATE_SUFFIX)])
    owners = [f.select(key, *own) for f, own in zip(frames[1:], owned[1:]) if own]
    others = [f.select(key) for f, own in zip(frames[1:], owned[1:]) if not own]
    counted = None
    if others:
        counted = reduce(
            DataFrame.union, [f.withColumn("_file", F.lit(i)) for i, f in enumerate(others)]
        )
    return fold([first, *owners], counted, len(others), how, key, skew, null_keys, max_result_rows)


def fold(
    owners: Sequence[DataFrame],
    counted: DataFrame | None,
    counted_files: int,
    how: str = "outer",
    key: str = KEY,
    skew: Skew = Skew(),
    null_keys: str = "match",
    max_result_rows: int | None = None,
) -> DataFrame:
    """Merge files that own columns, and rows (key, _file) of files that own none.

    Equal to folding all files one by one: a file without columns repeats each row as
    often as it holds the row's key, and `outer` adds the keys not yet there. Null keys
    match each other, unless `null_keys="keep"`: then they match nothing. A merge that would
    make more than `max_result_rows` rows, if given, is refused before it starts.
    """
    if null_keys not in ("match", "keep"):
        raise ValueError(f"unknown null key handling: {null_keys!r}")
    if null_keys == "keep":
        known = [f.filter(F.col(key).isNotNull()) for f in owners]
        known_counted = None if counted is None else counted.filter(F.col(key).isNotNull())
        merged = fold(known, known_counted, counted_files, how, key, skew, max_result_rows=max_result_rows)
        if how == "inner":
            return merged
        unknown = [*owners, *([] if counted is None else [counted.select(key)])]
        return reduce(
            lambda a, b: a.unionByName(b.filter(F.col(key).isNull()), allowMissingColumns=True),
            unknown, merged)
    times = None if counted is None else _repeat_counts(counted, counted_files, how, key)
    if len(owners) == 1 and times is None:
        return owners[0]
    found = count_keys(owners, how, key, skew, times)
    if max_result_rows is not None and found.result_rows > max_result_rows:
        raise ValueError(
            f"the merge would make {found.result_rows:.4g} rows, {found.null_key_rows:.4g} of them "
            "from null keys, all of which match each other")
    if found.null_key_rows > 1_000_000:
        log.warning("null keys alone make %.4g rows of this merge", found.null_key_rows)
    if times is None and len(owners) > 2 and found.most_per_key <= 1:
        return merge_unique(owners, how, key)
    steps = [*owners[1:], *([] if times is None else [_repeat_pieces(times, key)])]
    merged = owners[0]
    for step, hot in zip(steps, found.hot):
        merged = _join(merged, step, how, key, hot)
    if times is not None:
        copies = F.sequence(F.lit(1).cast("bigint"), F.coalesce("_repeat", F.lit(1).cast("bigint")))
        merged = merged.withColumn("_copy", F.explode(copies)).drop("_copy", "_repeat")
    return merged


def _repeat_counts(counted: DataFrame, files: int, how: str, key: str) -> DataFrame:
    """Rows (key, _times): how often files without columns repeat a key's rows, multiplied."""
    per_file = counted.groupBy(key, "_file").agg(F.count(F.lit(1)).alias("_n"))
    times = per_file.groupBy(key).agg(
        F.product("_n").alias("_times"), F.count(F.lit(1)).alias("_files")
    )
    return (times.filter(F.col("_files") == files) if how == "inner" else times).drop("_files")


def _repeat_pieces(times: DataFrame, key: str) -> DataFrame:
    """Rows (key, _repeat) that sum to `_times`, cut so that no task writes one key alone."""
    whole = times.withColumn("_times", F.col("_times").cast("bigint"))
    pieces = F.expr(f"sequence(0L, (_times - 1) div {REPEAT_ROWS})")
    left_over = F.col("_times") - F.col("_piece") * REPEAT_ROWS
    repeat = F.least(F.lit(REPEAT_ROWS).cast("bigint"), left_over)
    return whole.withColumn("_piece", F.explode(pieces)).select(key, repeat.alias("_repeat"))


def merge_unique(frames: Sequence[DataFrame], how: str = "outer", key: str = KEY) -> DataFrame:
    """The fold as one aggregation, for frames that hold every key at most once."""
    owned = own_columns([f.columns for f in frames], key)
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [f.select(key, *own) for f, own in zip(frames, owned)],
    )
    columns = [c for own in owned for c in own]
    merged = stacked.groupBy(key).agg(
        *[F.max(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_files")
    )
    if how == "inner":
        merged = merged.filter(F.col("_files") == len(frames))
    first = [c for c in frames[0].columns if not c.endswith(DUPLICATE_SUFFIX)]
    return merged.select(*first, *[c for c in columns if c not in first])


def null_key_pairs(left: DataFrame, right: DataFrame, key: str = KEY) -> int:
    """Rows a merge makes out of null keys alone: every left one meets every right one."""
    counts = [f.agg(F.count_if(F.col(key).isNull())).first()[0] for f in (left, right)]
    return counts[0] * counts[1]


def aligned_type(types: Sequence[str]) -> str:
    """Common type of a column in stacked files: the wider number, else text."""
    kinds = list(dict.fromkeys(types))
    if len(kinds) == 1:
        return kinds[0]
    if all(k in NUMERIC_ORDER for k in kinds):
        return max(kinds, key=NUMERIC_ORDER.index)
    return "string"


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, by column name, first-seen column order, gaps null."""
    types: dict[str, list[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            types.setdefault(name, []).append(kind)
    common = {name: aligned_type(kinds) for name, kinds in types.items()}

    def cast(frame: DataFrame) -> DataFrame:
        return frame.select(*[
            F.col(f"`{n}`") if t == common[n] else F.col(f"`{n}`").cast(common[n]).alias(n)
            for n, t in frame.dtypes
        ])

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [cast(f) for f in frames]
    )
