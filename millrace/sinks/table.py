"""Loading a table: validate the target, create its database, overwrite, report.

Tables of files are written aside and then take the target's name, so that a load that fails,
however far it came, leaves the rows that were there. In a catalog of its own, and in other
formats, replacing a table is the catalog's or the connector's work.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Name rules and messages of a load target.
PROJECT = r"[a-zA-Z0-9][a-zA-Z0-9_-]*[a-zA-Z0-9]"
NAME = r"[a-zA-Z_][a-zA-Z0-9_]*"
VALID = "Configuration is valid"
INVALID = "Configuration validation failed: %s"
NO_DATASET = "Failed to create dataset %s: %s"
GAVE_UP = "Upload failed after %d attempts: %s"


# Formats whose tables are folders of files, which a catalog can rename.
FILES = ("parquet", "orc", "csv", "json", "avro")


@dataclass(frozen=True)
class TableTarget:
    """Where to load: `table_id` is project.dataset.table.

    The project only names the table; with `catalog`, it is the Spark catalog as well.
    """

    project: str = ""
    dataset: str = ""
    table: str = ""
    format: str = "parquet"
    catalog: bool = False
    location: str | None = None  # folder of the database, if it is to be created

    @property
    def table_id(self) -> str:
        return f"{self.project}.{self.dataset}.{self.table}"

    @property
    def database(self) -> str:
        return ".".join(quoted(n) for n in ((self.project, self.dataset) if self.catalog else (self.dataset,)))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def validate_target(target: TableTarget | None) -> tuple[bool, str]:
    """The three names must be there and well formed, checked in that order.

    A project of one character passes whatever it is.
    """
    if target is None:
        return False, "A load target is required"
    for part in ("project", "dataset", "table"):
        if not getattr(target, part):
            return False, f"Target {part} is required"
    if len(target.project) > 1 and not re.fullmatch(PROJECT, target.project):
        return False, f"Invalid project ID format: {target.project}"
    if not re.fullmatch(NAME, target.dataset):
        return False, f"Invalid dataset ID format: {target.dataset}"
    if not re.fullmatch(NAME, target.table):
        return False, f"Invalid table ID format: {target.table}"
    return True, VALID


def load_table(df: DataFrame, target: TableTarget | None, retries: int = 3) -> dict:
    """Overwrite the target with `df`, schema included; rows are counted while writing.

    Spark retries tasks itself; `retries` repeats the whole load, which is safe as it
    overwrites. A database that cannot be created ends the load at once.
    """
    valid, message = validate_target(target)
    if not valid:
        return {"success": False, "error": INVALID % message}
    place = f" LOCATION {text(target.location)}" if target.location else ""
    try:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {target.database}{place}")
    except Exception as error:
        return {"success": False, "error": NO_DATASET % (f"{target.project}.{target.dataset}", error)}
    problem: Exception | None = None
    for _ in range(retries):
        observed = Observation()
        try:
            counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
            if target.catalog or target.format not in FILES:
                counted.write.format(target.format).mode("overwrite").saveAsTable(
                    f"{target.database}.{quoted(target.table)}")
            else:
                replace_table(counted, target.database, target.table, target.format)
        except Exception as error:
            problem = error
            continue
        return {
            "success": True,
            "table_id": target.table_id,
            "rows_uploaded": observed.get["rows"],
            "columns_uploaded": len(df.columns),
        }
    return {"success": False, "error": GAVE_UP % (retries, problem)}


def replace_table(df: DataFrame, database: str, table: str, format: str) -> None:
    """Write `df` to a table aside, then swap names; the old table goes last, or comes back."""
    spark = df.sparkSession
    name = lambda kind: f"{database}.{quoted(f'{table}__{kind}_{mark}')}"
    mark = uuid.uuid4().hex[:12]
    target, aside, old = f"{database}.{quoted(table)}", name("new"), name("old")
    try:
        df.write.format(format).mode("errorifexists").saveAsTable(aside)
        _swap(spark, target, aside, old)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        # A write that failed leaves its folder, though there is no such table.
        home = spark.catalog.getDatabase(database).locationUri
        path = spark._jvm.org.apache.hadoop.fs.Path(home, f"{table}__new_{mark}".lower())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _swap(spark: SparkSession, target: str, aside: str, old: str) -> None:
    there = spark.catalog.tableExists(target)
    if there:
        spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {old} RENAME TO {target}")
        raise
