"""Schema samples and compatibility of files, over the table of (file, column)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import URL_WORDS, header_names
from millrace.functions.values import NUMBER, WHOLE, BOOLEAN, MISSING, cell_class
from millrace.operators.attach import attach
from millrace.operators.profile import long_aggregate
from millrace.session import written

# Fewer common columns than this make files incompatible.
MIN_COMMON = 3
FEW_COMMON = "Files have very few common columns (%d)"
SAMPLE_ROWS = 5


def column_table(schemas: dict[str, Sequence[str]], spark) -> DataFrame:
    rows = [(f, i, c) for f, columns in schemas.items() for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "source_file string, position int, column string")


def common_columns(table: DataFrame) -> DataFrame:
    """Rows (column): the columns all files of a (source_file, column) table share."""
    files = table.agg(F.count_distinct("source_file").alias("_files"))
    per_column = table.groupBy("column").agg(F.count_distinct("source_file").alias("_in"))
    return per_column.join(files, F.col("_in") == F.col("_files")).select("column")


def all_columns(table: DataFrame) -> DataFrame:
    """Every column of any file, with the number of files that have it."""
    return table.groupBy("column").agg(F.count_distinct("source_file").alias("files"))


def url_flags(table: DataFrame) -> DataFrame:
    """Rows (source_file, has_url_column), judged on the names as read."""
    name = F.lower("column")
    hit = name.contains(URL_WORDS[0]) | name.contains(URL_WORDS[1]) | name.contains(URL_WORDS[2])
    return table.groupBy("source_file").agg(F.bool_or(hit).alias("has_url_column"))


def compatibility(table: DataFrame) -> DataFrame:
    """One row: files, common_columns, compatible, issues."""
    per_column = all_columns(table)
    files = table.agg(F.count_distinct("source_file").alias("files"))
    common = per_column.groupBy("files").agg(F.count(F.lit(1)).alias("_n"))
    joined = files.join(common, "files", "left").select(
        "files", F.coalesce("_n", F.lit(0)).alias("common_columns")
    )
    few = (F.col("files") > 1) & (F.col("common_columns") < MIN_COMMON)
    issue = F.format_string(FEW_COMMON, "common_columns")
    return joined.select(
        "files",
        "common_columns",
        (~few).alias("compatible"),
        F.when(few, F.array(issue)).otherwise(F.array().cast("array<string>")).alias("issues"),
    )


def check_schema_compatibility(schemas: dict[str, Sequence[str]], spark) -> tuple[bool, list[str]]:
    """Compatible, and the issues; files without a readable header are left out by the caller."""
    if len(schemas) <= 1:
        return True, []
    row = compatibility(column_table(schemas, spark)).first()
    return row["compatible"], list(row["issues"])


def choose_groups(groups: list, handling: str) -> list:
    """Apply `schema_handling`: auto keeps all, strict raises, skip drops odd files.

    `skip` leaves out files that lack a column most files have. Only distinct header
    lines are looked at, weighted by their number of files.
    """
    if handling == "auto" or not groups:
        return groups
    weights: dict[tuple, int] = {}
    for g in groups:
        names = tuple(header_names(g.header_line))
        weights[names] = weights.get(names, 0) + g.files
    files = sum(weights.values())
    if handling == "strict":
        common = set.intersection(*[set(names) for names in weights])
        if files > 1 and len(common) < MIN_COMMON:
            raise ValueError(FEW_COMMON % len(common))
        return groups
    if handling != "skip":
        raise ValueError(f"unknown schema handling: {handling!r}")
    having: dict[str, int] = {}
    for names, n in weights.items():
        for name in names:
            having[name] = having.get(name, 0) + n
    usual = {name for name, n in having.items() if 2 * n > files}
    return [g for g in groups if usual <= set(header_names(g.header_line))]


def schema_samples(staged, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows (source_file, columns, dtypes, row_count_sample, error) from each file's first rows.

    A row with too many fields among them makes the sample fail, as the sample is read
    strictly. Types: bigint, double, boolean or string.
    """
    everything: DataFrame = staged.extras["everything"]
    starts = everything.groupBy("_source").agg(F.min("_row").alias("_first"))
    heads = attach(
        everything.select("_source", "_header", "_row", "_bad", *staged.columns),
        written(starts, "starts"), ["_source"],
    ).filter(F.col("_row") < F.col("_first") + rows)
    classes = heads.select(
        "_source", "_header", F.col("_bad").isNotNull().alias("_long"),
        *[cell_class(F.col(c)).alias(c) for c in staged.columns],
    )

    def at_least(level: int):
        return lambda c: F.count_if(F.col(c) >= level)

    found = long_aggregate(classes, ["_source", "_header"], staged.columns, {
        "n": lambda c: F.count(F.lit(1)),
        "long": lambda c: F.count_if(F.col("_long")),
        "present": at_least(MISSING + 1),
        "whole": at_least(WHOLE),
        "numeric": at_least(NUMBER),
        "boolean": lambda c: F.count_if(F.col(c) == BOOLEAN),
    })
    present = F.col("present")
    kind: Column = (
        F.when(present == 0, "double")
        .when(F.col("whole") == present, F.when(present == F.col("n"), "bigint").otherwise("double"))
        .when(F.col("numeric") == present, "double")
        .when((F.col("boolean") == present) & (present == F.col("n")), "boolean")
        .otherwise("string")
    )
    starts_by_file = everything.select("_source", "_header").distinct()
    layout = staged.cells(starts_by_file).select("_source", "column", "position", "original_column")
    typed = found.withColumn("type", kind).join(layout, ["_source", "column"])
    entry = F.struct("position", F.col("original_column").alias("name"), "type")
    per_file = typed.groupBy(F.col("_source").alias("source_file")).agg(
        F.array_sort(F.collect_list(entry)).alias("_columns"),
        F.max("n").alias("row_count_sample"),
        F.max("long").alias("_long"),
    )
    return per_file.select(
        "source_file",
        F.col("_columns.name").alias("columns"),
        F.map_from_arrays(F.col("_columns.name"), F.col("_columns.type")).alias("dtypes"),
        F.col("row_count_sample").cast("int").alias("row_count_sample"),
        F.when(F.col("_long") > 0, "a row has more fields than the header").alias("error"),
    )
