"""File assessment: encoding, header, quoting and shape of every file, in one text scan.

Files with line breaks inside quotes, or with lone carriage returns, are put together from
their lines once more; their header is their first record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.operators.attach import attach
from millrace.session import written
from millrace.sources.records import Records, opens, row_place, without_end

# Fixed values of an assessment.
UTF8 = "utf-8"
LATIN1 = "latin-1"
DELIMITER = ","
UNDECODED = "Failed to decode file."
NO_COLUMNS = "No columns to parse from file"
READ_ERROR = "Pandas read error: "
UNCLOSED = "Error tokenizing data. C error: EOF inside string"
TOO_MANY_FIELDS = "Error tokenizing data. C error: Expected %d fields in line %d, saw %d\n"
TRIAL_ROWS = 10
FAILED = "Failed to process file"
SKIPPED = "Skipped for lack of columns most files have"

# A complete quoted field, doubled quotes included.
QUOTED_FIELD = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def unquoted(line: Column) -> Column:
    """The line without its complete quoted fields; any quote left over is an open one."""
    return F.when(line.contains('"'), F.regexp_replace(line, QUOTED_FIELD, "$1")).otherwise(line)


def comma_count(line: Column) -> Column:
    # In bytes: characters cannot be told in a line that is not valid UTF-8.
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(",")))


def field_count(line: Column) -> Column:
    return comma_count(unquoted(line)) + 1


def decoded_path(path: Column) -> Column:
    """Spark reports paths percent-encoded; this gives the path a reader accepts.

    The same for every row of a file, so all but the test is left out where it can be.
    """
    plain = F.when(
        path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    ).otherwise(path)
    return F.when(
        plain.startswith("file:///"), F.concat(F.lit("file:"), F.substring(plain, 8, 1 << 30))
    ).otherwise(plain)


def path_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """Rows (file_path, file_name, size_mb); contents are not read.

    A scan skips empty files, so these come from the file listing that Spark holds anyway.
    """
    files = _reader(spark, glob, recursive).format("binaryFile").load(path)
    sizes = files.select(
        decoded_path(F.col("_metadata.file_path")).alias("file_path"),
        (F.col("_metadata.file_size") / 1048576).alias("size_mb"),
    )
    listed = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string")
    listed = listed.select(decoded_path(F.col("path")).alias("file_path"))
    return listed.join(sizes, "file_path", "left").select(
        "file_path",
        path_name(F.col("file_path")).alias("file_name"),
        F.coalesce("size_mb", F.lit(0.0)).alias("size_mb"),
    )


def assess_files(spark: SparkSession, path: str | list[str], glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """One row per file.

    Columns: file_path, file_name, size_mb, working_encoding, likely_delimiter,
    issues_found, header (decoded header record), multi_line (some line ends inside quotes,
    or holds a carriage return), lines, max_commas.
    """
    return assess(spark, path, glob, recursive)[0].drop("header_row")


def scan_lines(spark: SparkSession, path: str | list[str], glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """(_path, _block, _place, value): physical lines, ended by line feeds, of all files."""
    text = _reader(spark, glob, recursive).option("lineSep", "\n").text(path)
    return text.select(
        decoded_path(F.col("_metadata.file_path")).alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        row_place().alias("_place"), "value",
    )


def assess(
    spark: SparkSession, path: str | list[str], glob: str = "*.csv", recursive: bool = True
) -> tuple[DataFrame, Records | None]:
    """The assessment, with `header_row` (the header's place), and the records of multi-line files."""
    lines = scan_lines(spark, path, glob, recursive)
    named = lines.select(F.col("_path").alias("file_path"), "_block", F.col("_place").alias("_id"), "value")
    found = written(assess_lines(named), "found")
    files = list_files(spark, path, glob, recursive)
    table = files.join(found, "file_path", "left")
    # Only files with some line longer than the header are looked at again.
    too_long = F.col("_max_fields") > field_count(F.col("header"))
    suspects = written(found.filter(~F.col("multi_line") & too_long).select("file_path"), "suspects")
    if suspects.isEmpty():
        table = table.withColumn("_trial", F.lit(None).cast("string"))
    else:
        table = table.join(trial_issues(attach(named, suspects, ["file_path"])), "file_path", "left")
    several = written(found.filter("multi_line").select(F.col("file_path").alias("_path"), "working_encoding"), "several")
    records = None
    if several.isEmpty():
        table = table.withColumn("_open", F.lit(False))
    else:
        text = decoded(F.col("value"), F.col("working_encoding"))
        records = Records(attach(lines, several, ["_path"]).withColumn("value", text).drop("working_encoding"))
        first = records.rows(first_only=True).select(
            F.col("_path").alias("file_path"), F.col("_row").alias("_first_row"), F.col("record").alias("_first_record"))
        opened = records.unclosed().select(F.col("_path").alias("file_path"), F.lit(True).alias("_open"))
        table = table.join(first, "file_path", "left").join(opened, "file_path", "left")
        table = table.withColumn("header", F.when(F.col("multi_line"), F.col("_first_record")).otherwise(F.col("header")))
        table = table.withColumn("header_row", F.when(F.col("multi_line"), F.col("_first_row")).otherwise(F.col("header_row")))
    opened = F.coalesce(F.col("_open"), F.lit(False))
    issues = (
        F.when(F.coalesce(F.col("lines"), F.lit(0)) == 0, F.array(F.lit(UNDECODED)))
        .when(F.col("header").isNull(), F.array(F.lit(READ_ERROR + NO_COLUMNS)))
        .when(opened, F.array(F.lit(READ_ERROR + UNCLOSED)))
        .when(F.col("_trial").isNotNull(), F.array("_trial"))
        .otherwise(F.array().cast("array<string>"))
    )
    return table.select(
        "file_path",
        "file_name",
        "size_mb",
        F.coalesce("working_encoding", F.lit(UTF8)).alias("working_encoding"),
        F.lit(DELIMITER).alias("likely_delimiter"),
        issues.alias("issues_found"),
        F.when(~opened, F.col("header")).alias("header"),
        F.coalesce("multi_line", F.lit(False)).alias("multi_line"),
        F.coalesce("lines", F.lit(0)).alias("lines"),
        F.coalesce("max_commas", F.lit(0)).alias("max_commas"),
        "header_row",
    ), records


def decoded(text: Column, encoding: Column) -> Column:
    """Text as read, which is its bytes, in the file's encoding."""
    return F.when(encoding == LATIN1, F.decode(text.cast("binary"), "ISO-8859-1")).otherwise(text)


def assess_lines(lines: DataFrame) -> DataFrame:
    """Aggregate rows (file_path, _block, _id, value) to one row per file.

    All state is of fixed size per file: counters, at most four line flags, one line.
    """
    value = without_end(F.col("value"))
    valid, open_quote = F.is_valid_utf8(value), opens(value) | value.contains("\r")
    flag = (
        F.when(~valid & open_quote, "bytes+quotes").when(~valid, "bytes").when(open_quote, "quotes")
    )
    place = F.when(F.trim(value) != "", F.struct("_block", "_id"))
    found = lines.select("file_path", value.alias("value"), flag.alias("_flag"), place.alias("_place")).groupBy(
        "file_path"
    ).agg(
        F.collect_set("_flag").alias("_flags"),
        F.min_by("value", "_place").alias("_header"),
        F.min("_place").alias("_first"),
        F.count(F.lit(1)).alias("lines"),
        F.max(comma_count(F.col("value"))).alias("max_commas"),
        F.max(field_count(F.col("value"))).alias("_max_fields"),
    )
    flags = F.col("_flags")
    invalid = F.array_contains(flags, "bytes") | F.array_contains(flags, "bytes+quotes")
    multi = F.array_contains(flags, "quotes") | F.array_contains(flags, "bytes+quotes")
    header = F.when(invalid, F.decode(F.col("_header").cast("binary"), "ISO-8859-1")).otherwise(
        F.col("_header")
    )
    return found.select(
        "file_path",
        F.when(invalid, LATIN1).otherwise(UTF8).alias("working_encoding"),
        header.alias("header"),
        multi.alias("multi_line"),
        "lines",
        "max_commas",
        "_max_fields",
        F.col("_first._id").alias("header_row"),
    )


def trial_issues(lines: DataFrame) -> DataFrame:
    """Rows (file_path, _trial): the first too long row among a file's first ten.

    Only the first block of each file is ranked, and the ranking keeps a few dozen lines
    per file before any shuffle.
    """
    heads = lines.filter("_block = 0")
    first = heads.withColumn(
        "_line", F.row_number().over(W.partitionBy("file_path").orderBy("_id"))
    ).filter(F.col("_line") <= 4 * TRIAL_ROWS)
    value = without_end(F.col("value"))
    first = first.filter(F.trim(value) != "").select("file_path", "_line", field_count(value).alias("_fields"))
    in_order = W.partitionBy("file_path").orderBy("_line")
    ranked = first.withColumn("_nth", F.row_number().over(in_order))
    # The header and the first row may set the width; later rows may not exceed it.
    width = F.max(F.when(F.col("_nth") <= 2, F.col("_fields"))).over(W.partitionBy("file_path"))
    bad = ranked.withColumn("_width", width).filter(
        (F.col("_nth") > 2) & (F.col("_nth") <= TRIAL_ROWS + 1) & (F.col("_fields") > F.col("_width"))
    )
    message = F.format_string(READ_ERROR + TOO_MANY_FIELDS, "_width", "_line", "_fields")
    return bad.groupBy("file_path").agg(F.min_by(message, "_line").alias("_trial"))


def _reader(spark: SparkSession, glob: str, recursive: bool):
    return spark.read.option("pathGlobFilter", glob).option(
        "recursiveFileLookup", str(recursive).lower())
