"""Type coercion of text columns: numbers if any value is one, else dates by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import date_format, parse_dates
from millrace.functions.names import is_date_name
from millrace.functions.values import cell_class, number, integer, MISSING, NUMBER, WHOLE
from millrace.operators.profile import long_aggregate


def numeric_evidence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, present, numeric, whole): how many values are there, numbers, integers."""
    classes = df.select(*[cell_class(F.col(f"`{c}`")).alias(c) for c in columns])
    return long_aggregate(classes, (), columns, {
        "present": lambda c: F.count_if(F.col(f"`{c}`") > MISSING),
        "numeric": lambda c: F.count_if(F.col(f"`{c}`") >= NUMBER),
        "whole": lambda c: F.count_if(F.col(f"`{c}`") == WHOLE),
    })


def coerce_numbers(
    df: DataFrame, columns: Sequence[str], min_share: float | None = None
) -> DataFrame:
    """Turn every text column with any numeric value into numbers, all else null.

    bigint if the column has no nulls and only integers, double otherwise. With
    `min_share`, that share of the present values must be numeric.
    """
    rows = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    found = {r["column"]: r for r in numeric_evidence(df, columns).collect()}
    out = []
    for name in df.columns:
        seen = found.get(name)
        if seen is None or seen["numeric"] == 0:
            out.append(F.col(f"`{name}`"))
        elif min_share is not None and seen["numeric"] < min_share * seen["present"]:
            out.append(F.col(f"`{name}`"))
        else:
            parse = integer if seen["whole"] == rows else number
            out.append(parse(F.col(f"`{name}`")).alias(name))
    return df.select(*out)


def coerce_dates(df: DataFrame, order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Parse the text columns named like dates, each in the format of its first value."""
    text = [n for n, t in df.dtypes if t == "string"]
    names = [c for c in (columns or text) if c in text and is_date_name(c)]
    if not names:
        return df
    place = F.struct(*order)
    firsts = df.agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(c) for c in names
    ])
    formats = firsts.select(*[date_format(c).alias(c) for c in names]).first()
    parsed = {c: parse_dates(F.col(c), F.lit(formats[c]), [formats[c]]).alias(c) for c in names}
    return df.select(*[parsed.get(c, F.col(f"`{c}`")) for c in df.columns])
