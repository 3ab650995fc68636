"""Missing-value profiles: fixed-size counters, one aggregation for all columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import KEY
from millrace.functions.values import percent, present

# Columns whose counters share one aggregation. Wider tables are profiled as a union of
# narrow aggregations, each reading its own columns only.
COLUMNS_PER_AGGREGATE = 64


def long_aggregate(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], measures: dict[str, Callable[[str], Column]],
    shared: dict[str, Column] | None = None,
) -> DataFrame:
    """Aggregate every column with every measure, as rows (by..., shared..., column, measures...).

    A measure maps a column name to an aggregate; `shared` ones are the group's. Rows are never
    multiplied: the counters sit side by side in one buffer and are turned to rows afterwards.
    """
    shared = shared or {}
    parts = []
    for start in range(0, len(columns), COLUMNS_PER_AGGREGATE):
        chunk = columns[start : start + COLUMNS_PER_AGGREGATE]
        wide = df.groupBy(*by).agg(
            *[measure.alias(m) for m, measure in shared.items()],
            *[measure(c).alias(f"_{i}_{m}") for i, c in enumerate(chunk)
              for m, measure in measures.items()]
        )
        rows = F.array(*[
            F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}_{m}").alias(m) for m in measures])
            for i, c in enumerate(chunk)
        ])
        parts.append(wide.select(*by, *shared, F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def column_nulls(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, rows, nulls); NaN is missing too."""
    return long_aggregate(
        df, by, columns,
        {
            "rows": lambda c: F.count(F.lit(1)),
            "nulls": lambda c: F.count_if(present(df, c).isNull()),
        },
    )


def null_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, nulls, missing_percent), two decimals; null on empty input."""
    return column_nulls(df, columns, by).withColumn(
        "missing_percent", percent(F.col("nulls"), F.col("rows"))
    ).drop("rows")


def is_sparse(missing: Column, rows: Column, threshold_percent: int | Column = 90) -> Column:
    """Strictly more than the threshold missing, in whole numbers."""
    return missing * 100 > rows * threshold_percent


def sparse_columns(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), threshold_percent: int = 90
) -> DataFrame:
    """Rows (by..., column, missing_percent, decision): drop, fill or keep. The key is exempt."""
    nulls, rows = F.col("nulls"), F.col("rows")
    decision = (
        F.when(F.col("column") == KEY, "keep")
        .when(is_sparse(nulls, rows, threshold_percent), "drop")
        .when(nulls > 0, "fill")
        .otherwise("keep")
    )
    profile = column_nulls(df, columns, by).withColumn("decision", decision)
    return profile.withColumn("missing_percent", percent(nulls, rows)).drop("rows", "nulls")


def drop_sparse_columns(df: DataFrame, threshold_percent: int = 90) -> DataFrame:
    """Drop the columns that are sparse in the whole frame (one row per column is collected)."""
    found = sparse_columns(df, df.columns, (), threshold_percent).filter("decision = 'drop'")
    return df.drop(*[row["column"] for row in found.collect()])


def missing_alerts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with strictly more than a tenth of their rows null: (column, nulls)."""
    found = column_nulls(df, columns or df.columns)
    return found.filter(F.col("nulls") * 10 > F.col("rows")).select("column", "nulls")


def key_stats(df: DataFrame, key: str = KEY, by: Sequence[str] = ()) -> DataFrame:
    """Rows, non-null keys and distinct keys."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(present(df, key)).alias("keys"),
        F.count_distinct(present(df, key)).alias("distinct_keys"),
    )
