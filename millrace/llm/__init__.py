"""Operators of a training-data pipeline: text and embedding tables, at corpus scale."""

from pathlib import Path


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(spark):
    """A session ready for tasks over texts: small Arrow batches, and workers that find the package.

    Texts may be long, so a batch has a thousand rows unless the user set another number. On
    this machine, workers import the package from wherever the driver did; on a cluster it is
    installed or sent along (`--py-files`), as any other.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark
