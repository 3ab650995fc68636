"""The master dataset: all cleaned files merged or stacked, its report, and saving it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import KEY, SOURCE
from millrace.operators.merge import Skew, fold
from millrace.operators.reports import master_report
from millrace.plans.clean import Batch

# Fixed values of the merge outcome.
NOTHING = "No valid dataframes to merge"
SINGLE = "Single file - no merging needed"
OUTER = "Outer join merge of %d files"
INNER = "Inner join merge of %d files"
STACKED = "Concatenated %d files without merging"
FAILED = "Merge failed: %s"


@dataclass(frozen=True)
class Master:
    data: DataFrame | None
    report: DataFrame | None
    merge_info: str


def build_master(
    batch: Batch, merge: str = "outer", skew: Skew = Skew(), null_keys: str = "match"
) -> Master:
    """Merge a batch's files in name order: `outer`, `inner` or `concat`.

    Files without rows are left out. The cleaned rows of all files are one table already,
    so stacking is that table, and a merge reads each owning file from it by its name.
    """
    if merge not in ("outer", "inner", "concat"):
        raise ValueError(f"unknown merge: {merge!r}")
    present = batch.decisions.filter("rows > 0")
    n, first = present.agg(F.count_distinct("_source"), F.min("_source")).first()
    if n == 0:
        return Master(None, None, NOTHING)
    if n == 1 or merge == "concat":
        return Master(batch.data, master_report(batch.data), SINGLE if n == 1 else STACKED % n)
    try:
        data = merge_batch(batch, n, first, merge, skew, null_keys)
    except Exception as error:  # reported, not raised: the batch itself is fine
        return Master(None, None, FAILED % error)
    return Master(data, master_report(data), (OUTER if merge == "outer" else INNER) % n)


def merge_batch(
    batch: Batch, n: int, first: str, how: str, skew: Skew = Skew(), null_keys: str = "match"
) -> DataFrame:
    """The fold over all `n` files with rows, from the table of cleaned rows.

    Only the owner of each column is collected, one row per column.
    """
    owned = owned_columns(batch, first)
    order = sorted(owned)
    source = F.col(SOURCE)
    frames = [
        batch.data.filter(source == f).select(KEY, *[F.col(f"`{c}`") for c in owned[f]]) for f in order
    ]
    mine = [c for c in batch.data.columns if c == KEY or c in owned[first]]
    frames[0] = frames[0].select(*[F.col(f"`{c}`") for c in mine])
    rest = n - len(order)
    counted = None
    if rest:
        counted = batch.data.filter(~source.isin(order)).select(KEY, source.alias("_file"))
    return fold(frames, counted, rest, how, KEY, skew, null_keys)


def owned_columns(batch: Batch, first: str) -> dict[str, list[str]]:
    """The columns that each owning file gives to a merge; the first file is always one."""
    columns = batch.decisions.filter("rows > 0 AND fate = 'keep'").groupBy("cleaned_column")
    owners = dict(columns.agg(F.min("_source")).collect()) | {SOURCE: first}
    owned: dict[str, list[str]] = {first: []}
    for name in batch.data.columns:
        if name != KEY and name in owners and not name.endswith("_dup"):
            owned.setdefault(owners[name], []).append(name)
    return owned
