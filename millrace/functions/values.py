"""Reading text cells: missing tokens, numbers, booleans, number text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cell texts read as missing. Exact, case-sensitive, untrimmed.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# try_cast alone would also take `1d`, `1f` and other Java spellings.
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
FINITE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITE = r"^\s*[+-]?(?i:inf|infinity)\s*$"


_TOKENS_SQL = ", ".join(f"'{token}'" for token in NULL_TOKENS)


def nullify(name: str) -> Column:
    """The text column of that name, null where it holds a token."""
    cell = f"`{name.replace('`', '``')}`"
    return F.expr(f"CASE WHEN {cell} NOT IN ({_TOKENS_SQL}) THEN {cell} END")


def present(df: DataFrame, name: str) -> Column:
    """The column of that name, null where it is not a number."""
    cell = F.col(f"`{name}`")
    return F.when(~F.isnan(cell), cell) if df.schema[name].dataType.typeName() in ("float", "double") else cell


def number(c: Column) -> Column:
    """Text to double; null where the text is not a plain decimal number."""
    value = c.try_cast("double")
    infinity = F.lit(float("inf"))
    return F.when(c.rlike(FINITE), F.when(F.abs(value) < infinity, value)).when(
        c.rlike(INFINITE), F.when(F.ltrim(c).startswith("-"), -infinity).otherwise(infinity)
    )


def integer(c: Column) -> Column:
    """Text to bigint; null for anything but an integer that fits."""
    return F.when(c.rlike(INTEGER), F.trim(c).try_cast("bigint"))


def boolean(c: Column) -> Column:
    return F.when(F.lower(c) == "true", F.lit(True)).when(F.lower(c) == "false", F.lit(False))


def boolean_text(c: Column) -> Column:
    return F.when(c, "True").when(~c, "False")


# Classes of a cell, ordered so that `>= NUMBER` means "is a number".
MISSING, TEXT, BOOLEAN, NUMBER, WHOLE = range(5)


def cell_class(c: Column) -> Column:
    # Numbers start with a blank, a sign, a point, a digit or the I of infinity, and
    # booleans have four or five letters; other texts never reach the patterns.
    first = F.ascii(c)
    numeric = (
        F.when(integer(c).isNotNull(), WHOLE).when(number(c).isNotNull(), NUMBER).otherwise(TEXT)
    )
    return (
        F.when(c.isNull(), MISSING)
        .when((first <= 57) | first.isin(73, 105), numeric)
        .when(F.length(c).between(4, 5) & boolean(c).isNotNull(), BOOLEAN)
        .otherwise(TEXT)
    )


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals, ties to even; null when `whole` is 0."""
    return F.rint(part * 100 / F.when(whole > 0, whole) * 100) / 100


def float_text(c: Column) -> Column:
    """A double as the shortest text with a point, `1e+16` style beyond 16 digits."""
    plain = c.cast("string")

    def trimmed(scale: int) -> Column:
        digits = plain.try_cast(f"decimal(38,{scale})").cast("string")
        return F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")

    mantissa = F.regexp_replace(F.split_part(plain, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(plain, F.lit("E"), F.lit(2)).try_cast("int")
    exponent = F.concat(
        F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0")
    )
    exponent = F.when(
        F.abs(power) > 99,
        F.concat(F.when(power < 0, "e-").otherwise("e+"), F.abs(power).cast("string")),
    ).otherwise(exponent)
    size = F.abs(c)
    return (
        F.when(c.isNull(), None)
        .when(F.isnan(c), "nan")
        .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when(c == 0, "0.0")
        .when((size >= 1e-3) & (size < 1e7), plain)
        .when((size >= 1e7) & (size < 1e16), trimmed(10))
        .when((size >= 1e-4) & (size < 1e-3), trimmed(25))
        .otherwise(F.concat(mantissa, exponent))
    )
