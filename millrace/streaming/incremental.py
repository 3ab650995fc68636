"""Cleaning only the files that are new or changed since the last run.

A file is known by path, modification time and size. The ledger is a table of the files of
every batch; a run lists the folder, takes what the ledger does not have, cleans it as one
batch and enters it. A batch writes to a folder of its own before it is entered, so a run
that was lost repeats it and overwrites what it left: no file is cleaned twice or lost. A
changed file is cleaned again in a later batch, and `current` drops what it had before. Files
are told apart by their paths: those of equal names in several folders are files of their own.

`clean_stream` does the same with a streaming file source for folders that only gain files, and
goes by content: a file whose lines were cleaned before, under whatever name and time, is only
entered in the ledger. Its batches are those of the stream's checkpoint. A batch writes its
outputs and its part of the ledger by its number, and what it takes for known are the parts of
lower numbers, so a batch that is run again after a loss does the same and overwrites the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.names import SOURCE
from millrace.plans.clean import CleanOptions, clean_files
from millrace.sources.assess import decoded_path, path_name

KNOWN = "path string, modified timestamp, size bigint, batch bigint"
OUTPUTS = ("data", "report", "status")
CONTENT = "path string, content string, lines bigint, same_as string"


def _listed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, modified, size) of the files below `path`; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    )
    found = files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    # A scan skips empty files; the listing has them.
    every = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string").select(decoded_path(F.col("path")).alias("path"))
    found = found.withColumn("path", decoded_path(F.col("path")))
    return every.join(found, "path", "left").withColumn("size", F.coalesce("size", F.lit(0)))


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    empty = spark.createDataFrame([], KNOWN)
    empty.write.mode("append").parquet(folder)  # so that there is a table to read
    return spark.read.schema(KNOWN).parquet(folder)


def clean_new_files(
    spark: SparkSession,
    path: str,
    output: str,
    ledger: str,
    glob: str = "*.csv",
    max_files: int = 10_000,
    options: CleanOptions = CleanOptions(),
) -> int:
    """Write `output/{data,report,status}/batch=N` for the new and changed files below `path`.

    Returns the number of batches; one has at most `max_files` files, the oldest first.
    """
    batches = 0
    while True:
        known = _ledger(spark, ledger)
        listed, seen = _listed(spark, path, glob), known.drop("batch")
        match = (listed["path"] == seen["path"]) & listed["modified"].eqNullSafe(seen["modified"]) & (listed["size"] == seen["size"])
        new = listed.join(seen, match, "left_anti").orderBy("modified", "path").limit(max_files).collect()
        if not new:
            return batches
        number = (known.agg(F.max("batch")).first()[0] or 0) + 1 if not known.isEmpty() else 0
        done = clean_files(spark, [row["path"] for row in new], glob, options=options)
        for name, frame in zip(OUTPUTS, (done.data, done.report, done.status)):
            frame.write.mode("overwrite").parquet(f"{output}/{name}/batch={number}")
        entered = spark.createDataFrame([(*row, number) for row in new], KNOWN)
        entered.coalesce(1).write.mode("append").parquet(ledger)
        batches += 1


def current(spark: SparkSession, output: str, name: str = "data") -> DataFrame:
    """Rows of all batches, of each file those of its last batch only.

    A file goes by its name, as in its batch, or by its path if another has the same name.
    """
    status = spark.read.parquet(f"{output}/status")
    last = status.groupBy(F.col("file_path").alias("_path")).agg(F.max_by(F.struct("batch", "file_name"), "batch").alias("_last"))
    last = last.select("_path", path_name(F.col("_path")).alias("_name"), F.col("_last.batch").alias("_batch"), F.col("_last.file_name").alias("_file"))
    shared = last.groupBy(F.col("_name").alias("_shared")).count().where("count > 1").drop("count")
    last = last.join(shared, last["_name"] == shared["_shared"], "left")
    last = last.select("_batch", "_file", F.when(F.col("_shared").isNull(), F.col("_name")).otherwise(F.col("_path")).alias("_called"))
    rows = spark.read.option("mergeSchema", "true").parquet(f"{output}/{name}")
    rows = rows.withColumnRenamed("file_name", SOURCE) if name == "status" else rows
    names = rows.columns
    found = rows.join(last, (rows[SOURCE] == last["_file"]) & (rows["batch"] == last["_batch"]))
    return found.withColumn(SOURCE, F.col("_called")).select(*[F.col(f"`{c}`") for c in names])


def content(lines: DataFrame, path: str = "path", line: str = "value", place: str = "place") -> DataFrame:
    """Rows (path, content, lines): a fingerprint of every file's lines.

    Its parts are sums, so that a file of any size is read split by split: the number of lines,
    two independent hashes added over them, and the first line. Files of the same lines in
    another order behind the first are alike; so are their cleaned rows, but for date columns
    whose first values are spelled differently.
    """
    def added(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), F.col(line)).cast("decimal(38,0)"))

    found = lines.groupBy(F.col(path).alias("path")).agg(
        F.count(F.lit(1)).alias("lines"), added(1).alias("_a"), added(2).alias("_b"),
        F.sha2(F.min_by(line, place), 256).alias("_first"))
    return found.select("path", F.concat_ws("/", "lines", "_a", "_b", "_first").alias("content"), "lines")


def clean_stream(
    spark: SparkSession,
    path: str,
    output: str,
    state: str,
    glob: str = "*.csv",
    max_files: int = 1000,
    options: CleanOptions = CleanOptions(),
) -> list[int]:
    """Clean the files that came below `path` since the last run, and return the batches that had any.

    Writes `output/{data,report,status}/batch=N`; `state` holds the stream's checkpoint and the
    ledger, a table of (path, content, lines, same_as) by batch, where `same_as` names the file
    that was cleaned if this one was not.
    """
    lines = (
        spark.readStream.format("text").schema("value string").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(path)
    )
    named = lines.select(
        decoded_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    done: list[int] = []

    def batch(rows: DataFrame, number: int) -> None:
        if _clean_batch(rows, number, output, f"{state}/ledger", glob, options):
            done.append(number)

    query = named.writeStream.foreachBatch(batch).trigger(availableNow=True).option("checkpointLocation", f"{state}/checkpoint").start()
    query.awaitTermination()
    return done


def _clean_batch(rows: DataFrame, number: int, output: str, ledger: str, glob: str, options: CleanOptions) -> bool:
    spark = rows.sparkSession
    known = _entered(spark, ledger).filter(F.col("batch") < number).filter("same_as IS NULL")
    known = known.groupBy("content").agg(F.min("path").alias("_before"))
    place = F.struct("block", F.monotonically_increasing_id())
    found = content(rows.select("path", "value", place.alias("place")))
    # Of equal files of one batch the first is cleaned.
    first = F.first("path").over(W.partitionBy("content").orderBy("path"))
    found = found.withColumn("_first", first).join(known, "content", "left")
    same = F.coalesce("_before", F.when(F.col("_first") != F.col("path"), F.col("_first")))
    found = found.select("path", "content", "lines", same.alias("same_as"))
    found.write.mode("overwrite").parquet(f"{ledger}/batch={number}")
    new = [r["path"] for r in spark.read.parquet(f"{ledger}/batch={number}").filter("same_as IS NULL").select("path").collect()]
    if new:
        cleaned = clean_files(spark, sorted(new), glob, options=options)
        for name, frame in zip(OUTPUTS, (cleaned.data, cleaned.report, cleaned.status)):
            frame.write.mode("overwrite").parquet(f"{output}/{name}/batch={number}")
    return bool(new)


def _entered(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger of all batches so far."""
    empty = spark.createDataFrame([], CONTENT)
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return empty.withColumn("batch", F.lit(0).cast("bigint"))
    return spark.read.schema(f"{CONTENT}, batch bigint").parquet(ledger)
