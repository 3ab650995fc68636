"""Session helpers: a local session, and the shared folder for written tables."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", name: str = "millrace", **conf: str) -> SparkSession:
    """A single-machine session, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """Set what wide projections need, unless the user set it.

    HotSpot does not compile methods above 8000 bytes; beyond that, Spark's own smaller
    methods are faster than one fused method.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == "65535":
        spark.conf.set(limit, "8000")


def stream_outer_joins(spark: SparkSession) -> None:
    """Let full outer joins give out row by row, unless the user set it.

    Their fused form keeps all rows that a key makes in memory before it gives out the first;
    the iterator keeps only the key's rows of both sides.
    """
    fused = "spark.sql.codegen.join.fullOuterSortMergeJoin.enabled"
    if spark.conf.get(fused, None) is None:
        spark.conf.set(fused, "false")


# What one shuffle partition should hold at most, uncompressed.
PARTITION_MB = 128


def size_shuffles(spark: SparkSession, megabytes: float) -> int:
    """Let shuffles start with enough partitions for that much data, unless the user set it.

    Adaptive execution merges them again where a shuffle turns out small, but never adds
    any, so the start must fit the largest one.
    """
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = math.ceil(megabytes / PARTITION_MB)
    now = spark.conf.get(start, None)
    if now is not None and now != _own_sizes.get(spark.sparkContext.applicationId):
        return int(now)
    if needed > max(usual, int(now or 0)):
        spark.conf.set(start, str(needed))
        _own_sizes[spark.sparkContext.applicationId] = str(needed)
    return max(usual, needed, int(now or 0))


_own_sizes: dict[str, str] = {}
_own_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in `spark.checkpoint.dir`.

    Only a local master without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _own_folders[context.applicationId]


def run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/millrace-{spark.sparkContext.applicationId}"


def write_table(df: DataFrame, label: str) -> str:
    """Write `df` to the shared folder and return its path.

    All tables of an application are in one folder, to be removed when its results are saved.
    """
    path = f"{run_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared folder: lineage ends here, losing an executor is harmless."""
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df, label))


def folder_mb(spark: SparkSession, path: str) -> float:
    """Size of a folder's files, from their listing."""
    files = spark.read.format("binaryFile").load(path).select("_metadata.file_size")
    return (files.agg({"file_size": "sum"}).first()[0] or 0) / 1048576
