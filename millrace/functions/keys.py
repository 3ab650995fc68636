"""The record key: first run of digits in a URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import KEY

DIGITS = r"(\p{Nd}+)"


def first_digits(text: Column) -> Column:
    """First run of (Unicode) digits as bigint; null if none or beyond 64 bits."""
    return F.nullif(F.regexp_extract(text, DIGITS, 1), F.lit("")).try_cast("bigint")


def first_digits_of_number(value: Column) -> Column:
    """The same for a column read as numbers, whose text is the number's own."""
    size = F.abs(value)
    positional = (size >= 1e-4) & (size < 1e16) | (size == 0)
    return F.when(positional, F.floor(size).cast("bigint")).otherwise(
        first_digits(value.cast("string"))
    )


def with_key(df: DataFrame, url: str | None) -> DataFrame:
    """Add the key column, over any column of that name; all null without a URL column."""
    if url is None:
        return df.withColumn(KEY, F.lit(None).cast("bigint"))
    kind = dict(df.dtypes)[url]
    numeric = kind in ("tinyint", "smallint", "int", "bigint", "float", "double")
    key = first_digits_of_number(F.col(url).cast("double")) if numeric else first_digits(
        F.col(url).cast("string"))
    return df.withColumn(KEY, key)
