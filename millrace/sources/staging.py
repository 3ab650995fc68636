"""The staged table: what a scan hands to the cleaning plan.

One row per input row, cells as read, under positional names `c0`, `c1`, ... with four
columns beside them: `_source` (file), `_header` (which header), `_row` (order within
the file), `_key` (record key) and `_summary` (a summary row, kept for the raw profile).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import names as N
from millrace.functions.keys import with_key
from millrace.functions.values import nullify
from millrace.operators.attach import attach
from millrace.operators.rows import is_summary_row
from millrace.session import folder_mb, prepare, size_shuffles, write_table

# How the type of a staged column is found.
INFERRED = "inferred"  # text, typed by looking at every value
TEXT = "text"  # text that stays text until coercion
TYPED = "typed"  # numbers and booleans as they are
OTHER = "other"  # other types, never numeric

# Roles of a column in its file.
PLAIN = "plain"
KEY_SOURCE = "key source"
OVERWRITTEN = "overwritten"

LAYOUT = (
    "_header int, cells array<struct<column: string, position: int, original_column: string, "
    "cleaned_column: string, role: string, reading: string, is_date: boolean, is_url: boolean>>"
)


@dataclass(frozen=True)
class Header:
    """One distinct header: its names as read and cleaned, and the key's column."""

    original: tuple[str, ...]
    cleaned: tuple[str, ...]
    url: str | None

    @classmethod
    def of(cls, original: Sequence[str], on_clash: str = "error", url: str | None = None) -> Header:
        cleaned = N.clean_names(original, on_clash)
        return cls(tuple(original), tuple(cleaned), url or N.find_url_column(cleaned))

    def role(self, name: str) -> str:
        if name in N.key_source_columns(self.cleaned, self.url):
            return KEY_SOURCE
        return OVERWRITTEN if name == N.KEY else PLAIN


@dataclass(frozen=True)
class Staged:
    data: DataFrame
    headers: list[Header]
    names: list[str]  # cleaned name of c0, c1, ...
    readings: dict[str, str]
    types: dict[str, str]  # Spark type of c0, c1, ...
    files: DataFrame | None = None  # (_source, _header), if files without rows count too
    summary_rows: bool = True
    extras: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f"c{i}" for i in range(len(self.names))]

    def layout(self) -> list[tuple]:
        """Rows as in LAYOUT: the columns of every distinct header."""
        ids = dict(zip(self.names, self.columns))
        return [
            (number, [
                (ids[name], position, original, name, header.role(name), self.readings[ids[name]],
                 N.is_date_name(name), name == header.url)
                for position, (original, name) in enumerate(zip(header.original, header.cleaned))
            ])
            for number, header in enumerate(self.headers)
        ]

    def cells(self, files: DataFrame) -> DataFrame:
        """Every column of every file of (_source, _header), with its place and role."""
        layout = self.layout()
        table = self.data.sparkSession.createDataFrame(layout, LAYOUT)
        size = sum(len(str(cell)) for _, header in layout for cell in header)
        return attach(files, table, ["_header"], size=size).select(
            "_source", "_header", F.inline("cells"))


def first_seen(headers: Sequence[Header]) -> list[str]:
    return list(dict.fromkeys(name for header in headers for name in header.cleaned))


def stage_frame(
    df: DataFrame,
    source: str | None = None,
    order: str | None = None,
    infer: bool = False,
    on_clash: str = "error",
    url: str | None = None,
    null_tokens: bool = False,
    write: bool = True,
) -> Staged:
    """Stage a DataFrame. `source` names the column that tells its files apart.

    `order` is a bigint column that orders rows; without one, rows are numbered as they
    are read, and the staged table is written so that the numbers stay. With `infer`,
    text columns are typed by their values, as in a CSV file. Every text column is kept
    as it is unless `null_tokens` asks for missing tokens to be read as null.
    """
    prepare(df.sparkSession)
    names = [c for c in df.columns if c not in (source, order)]
    header = Header.of(names, on_clash, url)
    columns = [f"c{i}" for i in range(len(names))]
    kinds = dict(df.dtypes)
    types = {c: kinds[n] for c, n in zip(columns, names)}
    readings = {}
    cells = []
    for c, n in zip(columns, names):
        cell, kind = F.col(f"`{n}`"), kinds[n]
        if kind == "string":
            readings[c] = INFERRED if infer else TEXT
            cells.append((nullify(n) if null_tokens or infer else cell).alias(c))
        elif kind in ("float", "double"):
            readings[c] = TYPED
            cells.append(F.when(~F.isnan(cell), cell).alias(c))
        else:
            readings[c] = TYPED if kind in ("tinyint", "smallint", "int", "bigint", "boolean") else OTHER
            cells.append(cell.alias(c))
    place = F.col(order).cast("bigint") if order else F.monotonically_increasing_id()
    staged = df.select(
        (F.col(f"`{source}`").cast("string") if source else F.lit("")).alias("_source"),
        F.lit(0).alias("_header"),
        place.alias("_row"),
        *cells,
    )
    url_column = columns[header.cleaned.index(header.url)] if header.url else None
    staged = with_key(staged, url_column).withColumnRenamed(N.KEY, "_key")
    staged = staged.withColumn("_summary", is_summary_row(columns))
    if write or not order:
        spark = df.sparkSession
        path = write_table(staged, "staged")
        staged = spark.read.schema(staged.schema).parquet(path)
        # Columnar and compressed, so worth about four times its size in a shuffle.
        size_shuffles(spark, 4 * folder_mb(spark, path))
    return Staged(staged, [header], list(header.cleaned), readings, types)
