"""Saving the master dataset: CSV folders with a time stamp, and a table if asked for."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.master import Master
from millrace.sinks.table import TableTarget, load_table, validate_target

# Default name and time stamp of saved files.
DEFAULT_NAME = "master_job_data"
STAMP = "%Y%m%d_%H%M%S"


def save_csv(df: DataFrame, folder: str, single_file: bool = False) -> float:
    """Write a CSV folder with headers and return its size in MB.

    One file per task; `single_file` is for small results, as one task writes it all.
    """
    rows = df.coalesce(1) if single_file else df
    rows.write.option("header", "true").option("quote", '"').option("escape", '"').csv(folder)
    spark = df.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    total = files.select(F.col("_metadata.file_size").alias("n")).agg(F.sum("n")).first()[0]
    return (total or 0) / 1048576


def save_master(
    master: Master,
    folder: str,
    output_name: str = DEFAULT_NAME,
    target: TableTarget | None = None,
    single_file: bool = False,
    now: datetime | None = None,
) -> dict:
    """Save data and report below `folder`, and load the table if `target` is given."""
    stamp = (now or datetime.now()).strftime(STAMP)
    csv_path = f"{folder}/{output_name}_{stamp}.csv"
    report_path = f"{folder}/{output_name}_report_{stamp}.csv"
    results = {
        "csv_file": csv_path,
        "report_file": report_path,
        "csv_size_mb": save_csv(master.data, csv_path, single_file),
    }
    save_csv(master.report, report_path, True)  # metrics only, a few rows per file
    if target is not None:
        valid, message = validate_target(target)
        if not valid:
            return results | {"table_success": False, "table_error": f"Configuration error: {message}"}
        loaded = load_table(master.data, target)
        results["table_success"] = loaded["success"]
        if loaded["success"]:
            results["table"] = loaded["table_id"]
            results["table_rows"] = loaded["rows_uploaded"]
        else:
            results["table_error"] = loaded["error"]
    return results
