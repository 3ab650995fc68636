"""CSV scans: the lines of all files are one scan, whatever their headers and encodings.

The scan takes the folder, not a list of files. What differs between files (header,
encoding, place of the header) comes from the assessment by a join, and what differs between
headers (places of the columns) by another, so the plan has one branch and grows with the
number of different columns only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import names as N
from millrace.functions.keys import first_digits
from millrace.functions.values import nullify
from millrace.operators.attach import attach
from millrace.operators.rows import is_summary_text
from millrace.session import prepare, size_shuffles, written
from millrace.sources.assess import FAILED, LATIN1, SKIPPED, assess, decoded, field_count, scan_lines
from millrace.sources.records import Records, without_end
from millrace.sources.schema import choose_groups
from millrace.sources.staging import INFERRED, Header, Staged, first_seen

ALL_LONG = "All rows have more fields than the header"


@dataclass(frozen=True)
class HeaderLine:
    """A distinct header record, and how many files have it."""

    header_line: str
    files: int


def header_lines(assessment: DataFrame) -> list[HeaderLine]:
    """Distinct headers in the order of their first file; one row each reaches the driver."""
    found = assessment.filter("header IS NOT NULL").groupBy("header").agg(
        F.min(F.struct("file_name", "file_path")).alias("first"), F.count(F.lit(1)).alias("files")
    ).collect()
    return [HeaderLine(r["header"], r["files"]) for r in sorted(found, key=lambda r: r["first"])]


def stage_csv(
    spark: SparkSession,
    path: str | list[str],
    glob: str = "*.csv",
    recursive: bool = True,
    on_clash: str = "error",
    url: str | None = None,
    schema_handling: str = "auto",
) -> Staged:
    """Assess, scan and stage every matching file below `path`.

    The result's `extras` hold `assessment` and `rejects` (_source, _row, record).
    Files are known by name, or by path where two share a name.
    """
    prepare(spark)
    assessment, records = assess(spark, path, glob, recursive)
    assessment = written(assessment, "assessment")
    lines = header_lines(assessment)
    readable = assessment.filter("header IS NOT NULL")
    total = readable.agg(
        F.sum("size_mb"), F.count_distinct("file_name") == F.count(F.lit(1)), F.bool_or(F.col("working_encoding") == LATIN1)
    ).first()
    size_shuffles(spark, total[0] or 0.0)
    by = "file_name" if total[1] else "file_path"
    assessment = assessment.withColumn("_source", F.col(by))
    chosen = choose_groups(lines, schema_handling)

    parsed: list[tuple[HeaderLine, Header]] = []
    errors = {line.header_line: SKIPPED for line in lines if line not in chosen}
    for line in chosen:
        try:
            parsed.append((line, Header.of(N.header_names(line.header_line), on_clash, url)))
        except ValueError as error:
            errors[line.header_line] = str(error)
    headers = list(dict.fromkeys(h for _, h in parsed))
    numbers = {h: i for i, h in enumerate(headers)}
    kinds = [(line.header_line, numbers[h], None) for line, h in parsed]
    kinds += [(line, None, message) for line, message in errors.items()]
    kinds = spark.createDataFrame(kinds, "header string, _header int, _error string")
    # One row per distinct header line.
    files = assessment.join(kinds, "header", "left").withColumn(
        "error",
        F.coalesce("_error", F.when(F.col("_header").isNull(), F.lit(FAILED))),
    ).drop("_error")

    names = first_seen(headers)
    columns = [f"c{i}" for i in range(len(names))]
    if not headers:
        everything = spark.createDataFrame(
            [], "_source string, _header int, _row bigint, _bad string, _key bigint, _summary boolean")
    else:
        table = files.filter("_header IS NOT NULL").select(
            F.col("file_path").alias("_path"), "_source", "_header", "header_row", "multi_line", "working_encoding")
        rows = _records(scan_lines(spark, path, glob, recursive), records, written(table, "files"), bool(total[2]))
        everything = written(_staged(rows, headers, names), "staged")
        # A file all of whose rows are too long was not read.
        kept = everything.groupBy("_source").agg(F.bool_and(F.col("_bad").isNotNull()).alias("_all_long"))
        files = files.join(written(kept.filter("_all_long"), "all_long"), "_source", "left").withColumn(
            "error", F.coalesce("error", F.when(F.col("_all_long"), F.lit(ALL_LONG)))).drop("_all_long")
    data = everything.filter("_bad IS NULL").drop("_bad")
    rejects = everything.filter("_bad IS NOT NULL").select("_source", "_row", F.col("_bad").alias("record"))
    return Staged(
        data,
        headers,
        names,
        {c: INFERRED for c in columns},
        {c: "string" for c in columns},
        files.filter("error IS NULL").select("_source", "_header"),
        extras={"assessment": files, "rejects": rejects, "everything": everything},
    )


def _records(lines: DataFrame, records: Records | None, files: DataFrame, latin1: bool) -> DataFrame:
    """(_source, _header, _row, record) of all files after their headers, decoded, without blank ones."""

    columns = ["_source", "_header", "_row", "record"]
    plain = lines.select("_path", F.col("_place").alias("_row"), without_end(F.col("value")).alias("record"))
    single = files if records is None else written(files.filter("NOT multi_line"), "single")
    rows = attach(plain, single, ["_path"]).filter("_row > header_row")
    if latin1:
        rows = rows.withColumn("record", decoded(F.col("record"), F.col("working_encoding")))
    rows = rows.select(*columns)
    if records is not None:
        joined = attach(records.rows(), written(files.filter("multi_line"), "several"), ["_path"])
        rows = rows.unionAll(joined.filter("_row > header_row").select(*columns))
    return rows.filter(F.trim("record") != "")


def _staged(rows: DataFrame, headers: list[Header], names: list[str]) -> DataFrame:
    """Rows parsed and laid out as columns c0, c1, ... of all headers.

    `_bad` holds a row with too many fields, which is to be skipped. Rows with too few are
    kept and padded with nulls.
    """
    widest = max(len(h.original) for h in headers)
    schema = ", ".join([*[f"k{i} string" for i in range(widest)], "_corrupt string"])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    place = {name: i for i, name in enumerate(names)}
    cells = rows.select("*", F.from_csv("record", schema, options).alias("_cells")).select(
        "_source", "_header", "_row", "record", "_cells.*")
    fixed = ["_source", "_header", "_row"]
    if len(headers) == 1:
        header = headers[0]
        own = [nullify(f"k{i}") for i in range(widest)]
        at = {name: i for i, name in enumerate(header.cleaned)}
        url = None if header.url is None else own[at[header.url]]
        return cells.select(
            *fixed, F.when(field_count(F.col("record")) > widest, F.col("record")).alias("_bad"),
            (F.lit(None).cast("bigint") if url is None else first_digits(url)).alias("_key"),
            is_summary_text(F.concat_ws(" ", *own)).alias("_summary"),
            *[own[at[name]].alias(f"c{i}") for i, name in enumerate(names)],
        )
    layout = []
    for number, header in enumerate(headers):
        places: list[int | None] = [None] * len(names)
        for i, name in enumerate(header.cleaned):
            places[place[name]] = i
        layout.append((number, len(header.original), None if header.url is None else header.cleaned.index(header.url), places))
    table = rows.sparkSession.createDataFrame(layout, "_header int, _width int, _url int, _places array<int>")
    # One row per header: as many numbers as headers times columns.
    laid = attach(cells, table, ["_header"], size=8 * len(headers) * (len(names) + 3))
    laid = laid.withColumn("_own", F.array(*[nullify(f"k{i}") for i in range(widest)]))
    return laid.select(
        *fixed, F.when(field_count(F.col("record")) > F.col("_width"), F.col("record")).alias("_bad"),
        first_digits(F.get("_own", F.col("_url"))).alias("_key"),
        is_summary_text(F.array_join(F.slice("_own", F.lit(1), F.col("_width")), " ")).alias("_summary"),
        *[F.get("_own", F.get("_places", F.lit(i))).alias(f"c{i}") for i in range(len(names))],
    )
