"""Reports as DataFrames: master overview, rows per source, batch totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import KEY, SOURCE
from millrace.operators.profile import missing_alerts

# Sections and metrics of the master report.
OVERVIEW = "Dataset Overview"
TOTAL_ROWS = "Total Rows"
TOTAL_COLUMNS = "Total Columns"
UNIQUE_KEYS = "Unique Job IDs"
SOURCE_FILES = "Source Files"
PER_SOURCE = "Records per Source File"
ALERTS = "Data Quality Alerts"
ABSENT = "N/A"


def records_per_source(df: DataFrame, source: str = SOURCE) -> DataFrame:
    """Rows per source file, most first; rows without a source are left out."""
    counts = df.filter(F.col(source).isNotNull()).groupBy(source).agg(
        F.count(F.lit(1)).alias("records")
    )
    return counts.orderBy(F.desc("records"), source)


def overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns, distinct keys, distinct sources (null where the column is absent)."""

    def distinct(name: str) -> Column:
        found = F.count_distinct(F.col(name)) if name in df.columns else F.lit(None).cast("bigint")
        return found

    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        distinct(KEY).alias("unique_keys"),
        distinct(SOURCE).alias("source_files"),
    ).select(
        "total_rows", F.lit(len(df.columns)).alias("total_columns"), "unique_keys", "source_files"
    )


def master_report(df: DataFrame) -> DataFrame:
    """Rows (section, metric, value): overview, rows per source, columns over a tenth empty."""
    one = overview(df)

    def grouped(c: Column) -> Column:
        return F.coalesce(F.format_number(c, 0), F.lit(ABSENT))

    plain = F.coalesce(F.col("source_files").cast("string"), F.lit(ABSENT))
    metrics = F.array(*[
        F.struct(F.lit(OVERVIEW).alias("section"), F.lit(name).alias("metric"), value.alias("value"))
        for name, value in (
            (TOTAL_ROWS, grouped(F.col("total_rows"))),
            (TOTAL_COLUMNS, F.col("total_columns").cast("string")),
            (UNIQUE_KEYS, grouped(F.col("unique_keys"))),
            (SOURCE_FILES, plain),
        )
    ])
    report = one.select(F.inline(metrics))
    if SOURCE in df.columns:
        report = report.unionByName(
            records_per_source(df).select(
                F.lit(PER_SOURCE).alias("section"),
                F.col(SOURCE).alias("metric"),
                F.col("records").cast("string").alias("value"),
            )
        )
    alerts = missing_alerts(df).select(
        F.lit(ALERTS).alias("section"),
        F.col("column").alias("metric"),
        F.col("nulls").cast("string").alias("value"),
    )
    return report.unionByName(alerts)


def batch_summary(status: DataFrame) -> DataFrame:
    """One row over a status table: files by outcome, rows and keys of the good ones."""
    good = F.col("success")
    return status.agg(
        F.count_if(good).alias("files_ok"),
        F.count_if(~good).alias("files_failed"),
        F.coalesce(F.sum(F.when(good, F.col("cleaned_rows"))), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(good, F.col("keys_found"))), F.lit(0)).alias("total_keys"),
    )


def file_table(status: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """One display row per file: name, status text, columns text, size text.

    With `samples` (of `schema_samples`), a file whose sample failed is shown as an error too.
    """
    issues = F.size("issues_found")
    if samples is not None:
        failed = samples.filter("error IS NOT NULL").select(F.col("source_file").alias("_sampled"), F.col("error").alias("_sample_error"))
        status = status.join(failed, status["file_name"] == failed["_sampled"], "left")
        status = status.withColumn("error", F.coalesce("error", "_sample_error")).drop("_sampled", "_sample_error")
    return status.select(
        "file_name",
        F.when(F.col("error").isNotNull(), F.concat(F.lit("Error: "), F.col("error")))
        .when(issues > 0, F.concat(issues.cast("string"), F.lit(" issues")))
        .otherwise("Valid")
        .alias("status"),
        F.when(F.col("error").isNotNull(), "N/A")
        .otherwise(F.concat(F.col("n_columns").cast("string"), F.lit(" columns")))
        .alias("columns"),
        F.when(F.col("error").isNotNull(), "N/A")
        .otherwise(F.format_string("%.2f MB", F.col("size_mb")))
        .alias("size"),
    )


def failures(status: DataFrame) -> DataFrame:
    return status.filter(~F.col("success")).select("file_name", "error")
