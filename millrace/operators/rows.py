"""Row operators: summary rows, full-row duplicates, previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that mark a row as a report's summary or header row. Substrings
# count, so `Subtotal` alone scores two and `Account total` scores two as well.
SUMMARY_WORDS = ("total", "summary", "average", "count", "subtotal")
SUMMARY_MIN_WORDS = 2


def is_summary_row(columns: Sequence[str], words: Sequence[str] = SUMMARY_WORDS) -> Column:
    """True where the row's joined, lower-cased text holds at least two of the words."""
    if not columns:
        return F.lit(False)
    return is_summary_text(F.concat_ws(" ", *[F.col(f"`{c}`").cast("string") for c in columns]), words)


def is_summary_text(text: Column, words: Sequence[str] = SUMMARY_WORDS) -> Column:
    text = F.lower(text)
    return reduce(add, [F.contains(text, F.lit(w)).cast("int") for w in words]) >= SUMMARY_MIN_WORDS


def drop_summary_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.filter(~is_summary_row(columns or df.columns))


def summary_row_counts(
    df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """How many rows `drop_summary_rows` removes, per group of `by`."""
    hit = is_summary_row(columns or [c for c in df.columns if c not in by])
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(hit).alias("summary_rows")
    )


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row of every group of equal rows; nulls, NaNs and the two zeros are equal."""
    return df.dropDuplicates()


def preview(df: DataFrame, order: Sequence[str] = (), n: int = 5) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)
