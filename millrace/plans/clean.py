"""The cleaning plan: staged rows of many files to cleaned rows and reports.

All statistics are per file, all of them distributed. The driver learns, per column and
never per file, which types and fills occur. However many files and columns there are,
the same few jobs run:

1. profile: counters per (file, column), one scan; decisions from them;
2. fill values, for the columns that need any, and first dates, for date columns;
3. apply: one projection of the staged rows with their file's decisions attached,
   followed by the removal of duplicate rows.

The order of steps matters and is kept: raw profile, summary rows out, key extracted,
sparse columns out, gaps filled, types coerced, duplicates out, source tagged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import values as V
from millrace.functions.dates import date_format, parse_dates
from millrace.functions.keys import DIGITS, first_digits_of_number
from millrace.functions.names import KEY, SOURCE
from millrace.operators.attach import attach
from millrace.operators.fills import exact_medians, exact_modes
from millrace.operators.merge import aligned_type
from millrace.operators.profile import is_sparse, long_aggregate
from millrace.plans.rules import by_file, renamed, with_summaries
from millrace.session import written
from millrace.sources.csv_files import stage_csv
from millrace.sources.staging import (
    INFERRED, KEY_SOURCE, LAYOUT, OTHER, OVERWRITTEN, TEXT, Staged, stage_frame,
)

# Fixed values of a cleaning report.
KEPT, FILLED, DROPPED = "Kept", "Filled", "Dropped"
DROPPED_SPARSE = "Dropped (>90% missing)"
DROPPED_KEY = "Dropped after job_id extraction"
DROPPED_RULE = "Dropped by rule"


@dataclass(frozen=True)
class CleanOptions:
    """Thresholds; the defaults give the documented behaviour."""

    sparse_percent: int = 90
    # Least share of numeric values that makes a text column numeric; None means any one.
    numeric_min_share: float | None = None
    # Write the cleaned rows to the shared folder, so that later steps do not recompute them.
    write_result: bool = True
    # Rules for all or for some files, as rows (file, kind, column, value); see `plans.rules`.
    rules: DataFrame | None = None


@dataclass(frozen=True)
class Batch:
    """Cleaned rows of all files, the report per file and column, the status per file."""

    data: DataFrame
    report: DataFrame
    status: DataFrame
    decisions: DataFrame
    rejects: DataFrame | None = None
    # (source_file, row, column, value, reason): texts that cleaning made null.
    rejected_values: DataFrame | None = None
    # The cleaned rows before duplicates are dropped, with their place `_row` in their file.
    origins: DataFrame | None = None


def clean_files(
    spark: SparkSession,
    path: str | list[str],
    glob: str = "*.csv",
    recursive: bool = True,
    on_clash: str = "error",
    url: str | None = None,
    schema_handling: str = "auto",
    options: CleanOptions = CleanOptions(),
) -> Batch:
    """Clean every CSV file below `path`, each by its own statistics."""
    staged = stage_csv(spark, path, glob, recursive, on_clash, url, schema_handling)
    return clean_staged(staged, options)


def clean_table(
    df: DataFrame,
    source: str | None = None,
    order: str | None = None,
    infer: bool = False,
    on_clash: str = "error",
    url: str | None = None,
    options: CleanOptions = CleanOptions(),
    write_stage: bool = True,
) -> Batch:
    """Clean a DataFrame, such as a Parquet table, by the rows' `source` column."""
    staged = stage_frame(df, source, order, infer, on_clash, url, write=write_stage)
    return clean_staged(staged, options)


def clean_staged(staged: Staged, options: CleanOptions = CleanOptions()) -> Batch:
    if not staged.columns:
        return _nothing(staged)
    rules = None
    if options.rules is not None:
        rules = by_file(options.rules, staged)
        staged = with_summaries(staged, rules)
    decisions = written(decide(staged, options, rules), "decisions")
    usage = column_usage(decisions)
    kept = staged.data.filter(~F.col("_summary")).drop("_summary")
    fills = fill_values(kept, staged, usage)
    firsts = first_values(kept, decisions, staged, usage)
    if fills is not None or firsts is not None:
        decisions = written(completed(decisions, fills, firsts), "completed")
    else:
        decisions = completed(decisions, None, None)
    facts = column_facts(decisions) if usage else {}
    origins = apply_decisions(kept, decisions, staged, usage, facts)
    data = origins.drop("_row").dropDuplicates()
    shown = decisions
    if rules is not None:
        data, origins = renamed(data, rules), renamed(origins, rules)
        names = F.coalesce(F.col("renames")[F.col("cleaned_column")], F.col("cleaned_column"))
        shown = attach(decisions, rules.select("_source", "renames"), ["_source"], how="left").withColumn("cleaned_column", names).drop("renames")
    if options.write_result:
        # A merge reads each owning file from this table: rows of a file lie together, so the
        # statistics of row groups and pages leave out the rest.
        data = written(data.sortWithinPartitions(SOURCE), "cleaned")
    return Batch(
        data, report(shown, staged), status(data, decisions, staged), decisions,
        staged.extras.get("rejects"), rejected_values(kept, decisions, staged, usage, facts), origins,
    )


def _nothing(staged: Staged) -> Batch:
    """No file could be read: no rows, only the status of each file."""
    spark = staged.data.sparkSession
    data = spark.createDataFrame([], f"{KEY} bigint, {SOURCE} string")
    decisions = spark.createDataFrame(
        [], "_source string, _header int, raw_rows bigint, rows bigint, fate string, cleaned_column string")
    empty = spark.createDataFrame(
        [], "source_file string, position int, original_column string, missing_percent_before double, "
        "cleaned_column string, action string, details string")
    return Batch(data, empty, status(data, decisions, staged), decisions, staged.extras.get("rejects"))


def decide(staged: Staged, options: CleanOptions, rules: DataFrame | None = None) -> DataFrame:
    """One row per (file, column): what it is, what becomes of it, how gaps are filled."""
    by = ["_source", "_header"]
    if not staged.columns:
        raise ValueError("no readable file with a usable header")
    profile = _side_by_side(staged, by) if len(staged.headers) == 1 else _by_cell(staged, by)
    if staged.files is None:  # one header
        layout = staged.data.sparkSession.createDataFrame(staged.layout(), LAYOUT)
        layout = layout.select("_header", F.inline("cells"))
        cells = profile.join(F.broadcast(layout), ["_header", "column"])
    else:
        cells = staged.cells(staged.files).join(
            profile.drop("_header"), ["_source", "column"], "left")
    cells = cells.fillna(0, list(COUNTERS))
    if rules is None:
        return _judge(cells, options)
    own = rules.drop("words", "renames")
    return _judge(attach(cells, own, ["_source"], how="left"), options, True).drop(*own.drop("_source").columns)


# Counters of a column of a file: by all of its rows, and by those that are no summary rows.
RAW = {"raw_present": V.TEXT, "raw_boolean": None, "raw_numeric": V.NUMBER, "raw_whole": V.WHOLE}
KEPT_ROWS = {"present": V.TEXT, "numeric": V.NUMBER, "whole": V.WHOLE}
COUNTERS = ("raw_rows", "rows", "first_row", *RAW, *KEPT_ROWS)


def _side_by_side(staged: Staged, by: Sequence[str]) -> DataFrame:
    """The counters of one header's columns, all in one buffer per file; rows are never multiplied."""
    def level(c: str) -> Column:
        value, known = _value_and_class(c, staged)
        return (known if staged.readings[c] not in (INFERRED, TEXT) else V.cell_class(value)).cast("tinyint").alias(c)

    cells = staged.data.select(*by, "_summary", "_row", *[level(c) for c in staged.columns])
    kept = ~F.col("_summary")

    def counter(least: int | None, only: Column | None = None) -> Callable[[str], Column]:
        def measure(c: str) -> Column:
            hit = F.col(c) == V.BOOLEAN if least is None else F.col(c) >= least
            return F.count_if(hit if only is None else hit & only)
        return measure

    measures = {name: counter(least) for name, least in RAW.items()}
    measures |= {name: counter(least, kept) for name, least in KEPT_ROWS.items()}
    return long_aggregate(cells, by, staged.columns, measures, {
        "raw_rows": F.count(F.lit(1)), "rows": F.count_if(kept), "first_row": F.min(F.when(kept, F.col("_row")))})


def _by_cell(staged: Staged, by: Sequence[str]) -> DataFrame:
    """The same for many headers: a row's own cells become rows, and only counts are shuffled.

    However many columns all headers have together, a file is counted by its own.
    """
    cells = staged.data.select(*by, "_summary", "_row", F.inline(_own_cells(staged)))
    level = F.coalesce(F.col("known"), V.cell_class(F.col("value")))
    counts = cells.groupBy(*by, "_summary", "column", level.alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_row").alias("first"))
    kept, n, level = ~F.col("_summary"), F.col("n"), F.col("level")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    def counter(least: int | None) -> Column:
        return level == V.BOOLEAN if least is None else level >= least

    return counts.groupBy(*by, "column").agg(
        F.sum(n).alias("raw_rows"), total(kept).alias("rows"), F.min(F.when(kept, F.col("first"))).alias("first_row"),
        *[total(counter(least)).alias(name) for name, least in RAW.items()],
        *[total(kept & counter(least)).alias(name) for name, least in KEPT_ROWS.items()])


def _own_cells(staged: Staged) -> Column:
    """The cells of a row's own header, as an array; columns of other headers are not in it."""

    place = dict(zip(staged.names, staged.columns))

    def cells(names: Sequence[str]) -> Column:
        return F.array(*[
            F.struct(F.lit(c).alias("column"), *_value_and_class(c, staged))
            for c in (place[n] for n in names)
        ])

    by_header = [cells(h.cleaned) for h in staged.headers]
    chosen = by_header[0]
    for number, own in enumerate(by_header[1:], 1):
        chosen = F.when(F.col("_header") == number, own).otherwise(chosen)
    return chosen


def _value_and_class(c: str, staged: Staged) -> tuple[Column, Column]:
    """A cell as text still to be classed, or, in a typed column, its class."""
    cell, reading = F.col(c), staged.readings[c]
    if reading in (INFERRED, TEXT):
        return cell.alias("value"), F.lit(None).cast("int").alias("known")
    level = V.TEXT if reading == OTHER else {
        "boolean": V.BOOLEAN, "float": V.NUMBER, "double": V.NUMBER}.get(staged.types[c], V.WHOLE)
    known = F.when(cell.isNull(), V.MISSING).otherwise(level)
    return F.lit(None).cast("string").alias("value"), known.alias("known")


def _judge(cells: DataFrame, options: CleanOptions, ruled: bool = False) -> DataFrame:
    """What becomes of each column; `ruled` cells have the rules of their file beside them."""
    c = F.col
    sparse, share, dropped = F.lit(options.sparse_percent), F.lit(options.numeric_min_share).cast("double"), F.lit(False)
    if ruled:
        sparse = F.coalesce(c("column_sparse")[c("cleaned_column")].cast("double"), c("sparse"), sparse)
        share = F.coalesce(c("share"), share)
        dropped = F.coalesce(F.array_contains("dropped", c("cleaned_column")), dropped)
    raw_missing = c("raw_rows") - c("raw_present")
    missing = c("rows") - c("present")
    # Typing happens on the rows as read, before summary rows leave.
    kind = (
        F.when(c("reading") == OTHER, "other")
        .when((c("reading") == TEXT) | (c("raw_rows") == 0), "text")
        .when(c("raw_present") == 0, "double")
        .when(c("raw_whole") == c("raw_present"), F.when(raw_missing == 0, "whole").otherwise("double"))
        .when(c("raw_numeric") == c("raw_present"), "double")
        .when(c("raw_boolean") == c("raw_present"), "boolean")
        .otherwise("text")
    )
    fate = (
        F.when(c("role") == KEY_SOURCE, "key source")
        .when(c("role") == OVERWRITTEN, "key")
        .when(dropped, "rule")
        .when(is_sparse(missing, c("rows"), sparse), "sparse")
        .otherwise("keep")
    )
    judged = cells.withColumns({"raw_missing": raw_missing, "missing": missing}).withColumns(
        {"kind": kind, "fate": fate})
    stays = c("fate") == "keep"
    fill = F.when(
        stays & (c("missing") > 0),
        F.when(c("kind").isin("whole", "double"), "median").otherwise("mode"),
    )
    enough = c("numeric") > 0
    if ruled or options.numeric_min_share is not None:
        enough = enough & (share.isNull() | (c("numeric") >= share * c("present")))
    # Booleans with gaps only in summary rows are an object column without gaps, which
    # counts as numeric.
    late_boolean = (c("kind") == "boolean") & (c("raw_missing") > 0) & (c("missing") == 0)
    change = F.when(
        stays,
        F.when((c("kind") == "text") & enough, "numeric")
        .when((c("kind") == "text") & c("is_date"), "datetime")
        .when(late_boolean, "numeric"),
    )
    judged = judged.withColumns({"fill": fill, "change": change})
    number = F.when(c("whole") == c("present"), "bigint").otherwise("double")
    out = (
        F.when(c("kind") == "whole", "bigint")
        .when(c("kind").isin("double", "boolean", "other"), c("kind"))
        .when(c("change") == "numeric", number)
        .when(c("change") == "datetime", "timestamp_ntz")
        .otherwise("string")
    )
    # The fill value to look up; modes of booleans are taken over values, not spellings.
    stat = F.when(
        c("fill") == "mode",
        F.when(c("kind") == "boolean", F.concat("column", F.lit("?"))).otherwise(c("column")),
    ).when(c("fill") == "median", F.concat("column", F.lit("~")))
    return judged.withColumns({"out": F.when(stays, out), "stat": stat})


@dataclass(frozen=True)
class Usage:
    """What happens to a column in at least one file with rows."""

    outs: list[str]
    median: bool
    mode: bool
    boolean_mode: bool
    dates: bool
    always_kept: bool
    numeric_url: bool
    max_rows: int
    source_bytes: int


def column_usage(decisions: DataFrame) -> dict[str, Usage]:
    """One collected row per column."""
    c = F.col
    rows = decisions.filter("rows > 0").groupBy("column").agg(
        F.collect_set("out").alias("outs"),
        F.bool_or(c("fill") == "median").alias("median"),
        F.bool_or((c("fill") == "mode") & (c("kind") != "boolean")).alias("mode"),
        F.bool_or((c("fill") == "mode") & (c("kind") == "boolean")).alias("boolean_mode"),
        F.bool_or(c("change") == "datetime").alias("dates"),
        F.bool_and(c("fate") == "keep").alias("always_kept"),
        F.bool_or(c("is_url") & (c("kind") == "double")).alias("numeric_url"),
        F.max("rows").alias("max_rows"),
        F.sum(F.octet_length("_source") + 16).alias("source_bytes"),
    ).collect()
    return {
        r["column"]: Usage(sorted(r["outs"]), bool(r["median"]), bool(r["mode"]),
                           bool(r["boolean_mode"]), bool(r["dates"]), r["always_kept"],
                           r["numeric_url"], r["max_rows"], r["source_bytes"])
        for r in rows
    }


def _number(c: str, staged: Staged) -> Column:
    return V.number(F.col(c)) if staged.types[c] == "string" else F.col(c).cast("double")


def _boolean(c: str, staged: Staged) -> Column:
    return V.boolean(F.col(c)) if staged.types[c] == "string" else F.col(c).cast("boolean")


def fill_values(kept: DataFrame, staged: Staged, usage: dict[str, Usage]) -> DataFrame | None:
    """Rows (_source, stat, number, text); read from the columns that need fills only."""
    medians = {c: _number(c, staged) for c, u in usage.items() if u.median}
    modes = {c: F.col(c).cast("string") for c, u in usage.items() if u.mode}
    modes |= {f"{c}?": V.boolean_text(_boolean(c, staged)) for c, u in usage.items() if u.boolean_mode}
    parts = []
    if medians:
        most = max(usage[c].max_rows for c in medians)
        parts.append(exact_medians(kept, medians, ["_source"], most).select(
            "_source", F.concat("column", F.lit("~")).alias("stat"), F.col("median").alias("number"),
            F.lit(None).cast("string").alias("text")))
    if modes:
        parts.append(exact_modes(kept, modes, ["_source"]).select(
            "_source", F.col("column").alias("stat"), F.lit(None).cast("double").alias("number"),
            F.col("mode").alias("text")))
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts)


def first_values(
    kept: DataFrame, decisions: DataFrame, staged: Staged, usage: dict[str, Usage]
) -> DataFrame | None:
    """Rows (_source, column, first): date columns' cells in the first row of each file."""
    columns = [c for c, u in usage.items() if u.dates and staged.types[c] == "string"]
    if not columns:
        return None
    firsts = decisions.filter("rows > 0").groupBy("_source").agg(F.min("first_row").alias("_row"))
    size = sum(u.source_bytes for u in usage.values())
    heads = attach(
        kept.select("_source", "_row", *columns), firsts.withColumn("_hit", F.lit(True)),
        ["_source", "_row"], size=size)
    return heads.select("_source", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("first")) for c in columns])))


def completed(
    decisions: DataFrame, fills: DataFrame | None, firsts: DataFrame | None
) -> DataFrame:
    """Add `number` and `text`, the fill value, and `format`, the date format once filled."""
    nothing = F.lit(None).cast("string")
    if fills is not None:
        decisions = decisions.join(fills, ["_source", "stat"], "left")
    else:
        decisions = decisions.withColumns({"number": F.lit(None).cast("double"), "text": nothing})
    if firsts is None:
        return decisions.withColumn("format", nothing)
    joined = decisions.join(firsts, ["_source", "column"], "left").withColumn(
        "first", F.when(F.col("change") == "datetime", F.coalesce("first", "text")))
    return joined.withColumn("format", date_format("first")).drop("first")


@dataclass(frozen=True)
class Facts:
    """What a column's decisions hold: the formats in use, and the bytes to attach them."""

    formats: list[str | None]
    plan_bytes: int


def column_facts(decisions: DataFrame) -> dict[str, Facts]:
    """One collected row per column; formats are at most as many as there are known ones."""
    dated = F.col("change") == "datetime"
    entry = F.coalesce(F.octet_length("text"), F.lit(0)) + F.octet_length("_source") + 64
    rows = decisions.filter("rows > 0").groupBy("column").agg(
        F.collect_set(F.when(dated, F.col("format"))).alias("known"),
        F.bool_or(dated & F.col("format").isNull()).alias("free"),
        F.sum(entry.cast("bigint")).alias("plan_bytes"),
    ).collect()
    return {
        r["column"]: Facts([*sorted(r["known"]), *([None] if r["free"] else [])], r["plan_bytes"])
        for r in rows
    }


def apply_decisions(
    kept: DataFrame,
    decisions: DataFrame,
    staged: Staged,
    usage: dict[str, Usage],
    facts: dict[str, Facts],
) -> DataFrame:
    """Fill, coerce, drop and name the columns, tag the source; `_row` is a row's place in its file."""
    live = [c for c in staged.columns if c in usage and usage[c].outs]

    def own_plan(c: str) -> bool:
        u = usage[c]
        return (u.median or u.mode or u.boolean_mode or u.dates or len(u.outs) > 1
                or not u.always_kept)

    planned = [c for c in live if own_plan(c)]
    rows = kept
    if planned:
        entry = F.struct("column", (F.col("fate") == "keep").alias("keep"), "out", "number", "text", "format")
        present = decisions.filter(F.col("column").isin(planned))
        plans = present.groupBy("_source").agg(
            F.map_from_entries(F.collect_list(F.struct(F.col("column"), entry))).alias("_all"))
        plans = plans.select("_source", F.struct(
            *[F.col("_all")[c].alias(c) for c in planned]).alias("_plan"))
        size = sum(facts[c].plan_bytes for c in planned)
        rows = attach(kept, plans, ["_source"], how="left", size=size)
    named = dict(zip(staged.columns, staged.names))
    chosen = set(planned)
    cells = {
        named[c]: _cell(c, staged, usage[c], c in chosen, facts[c].formats)
        for c in live
    }
    names = [n for n in staged.names if n in cells or n == KEY]
    if KEY not in names:
        names.append(KEY)
    rows, cells[KEY] = _with_numeric_urls(rows, decisions, staged, usage)
    named = [cells[n].alias(n) for n in names if n != SOURCE]
    return rows.select(*named, F.col("_source").alias(SOURCE), "_row")


def _with_numeric_urls(
    rows: DataFrame, decisions: DataFrame, staged: Staged, usage: dict[str, Usage]
) -> tuple[DataFrame, Column]:
    """The key, read from the number's own text where a file's URL column holds numbers only."""
    key = F.col("_key")
    columns = [c for c, u in usage.items() if u.numeric_url and staged.types[c] == "string"]
    if not columns:
        return rows, key
    found = decisions.filter(F.col("is_url") & (F.col("kind") == "double")).select(
        "_source", F.col("column").alias("_url"))
    for c in columns:
        key = F.when(F.col("_url") == c, first_digits_of_number(V.number(F.col(c)))).otherwise(key)
    size = sum(usage[c].source_bytes for c in columns)
    return attach(rows, found, ["_source"], how="left", size=size), key


def _cell(c: str, staged: Staged, use: Usage, planned: bool, formats: Sequence[str | None] | None) -> Column:
    """The cleaned value of a column; with a plan, by the file's own decision."""
    plan = F.col("_plan")[c] if planned else None
    text = staged.types[c] == "string"
    cell = F.col(c)
    if use.mode or use.boolean_mode:
        cell = F.coalesce(cell, plan["text"].cast(staged.types[c]))

    def number() -> Column:
        value = V.number(cell) if text else cell.cast("double")
        return F.coalesce(value, plan["number"]) if use.median else value

    def converted(out: str) -> Column:
        if out == "double":
            return number()
        if out == "bigint":
            return V.integer(cell) if text else cell.cast("bigint")
        if out == "boolean":
            return V.boolean(cell) if text else cell
        if out == "timestamp_ntz":
            return parse_dates(cell, plan["format"], formats or [None])
        return cell

    common = use.outs[0] if len(use.outs) == 1 else aligned_type(use.outs)
    if len(use.outs) == 1 or common == "double":
        value = converted(common)
    else:
        as_text = {
            o: V.float_text(converted(o)) if o == "double" else converted(o).cast("string")
            for o in use.outs
        }
        value = F.lit(None).cast("string")
        for o, expression in as_text.items():
            value = F.when(plan["out"] == o, expression).otherwise(value)
    return value if use.always_kept else F.when(plan["keep"], value)


# Why a value was made null.
NOT_A_NUMBER, NOT_A_DATE, NOT_A_KEY = "not a number", "not a date in the column's format", "key beyond 64 bits"


def rejected_values(
    kept: DataFrame, decisions: DataFrame, staged: Staged, usage: dict[str, Usage], facts: dict[str, Facts]
) -> DataFrame:
    """Rows (source_file, row, column, value, reason): every text that coercion or the key made null.

    `row` is the row's place in its file. Together with the cells that were kept or filled, these
    are all of the input: a value is null in the result if it was missing and not filled, if its
    column was dropped, or if it is here. Only columns that some file coerces are read.
    """
    coerced = [c for c, u in usage.items() if staged.types[c] == "string" and u.outs != ["string"] and u.outs]
    urls = [c for c, h in _url_columns(staged).items() if staged.types[c] == "string"]
    named = dict(zip(staged.columns, staged.names))
    schema = "source_file string, row bigint, column string, value string, reason string"
    if not coerced and not urls:
        return kept.sparkSession.createDataFrame([], schema)
    entry = F.struct("column", F.struct("out", (F.col("fate") == "keep").alias("keep"), "is_url", "format").alias("plan"))
    plans = decisions.filter(F.col("column").isin(sorted({*coerced, *urls}))).groupBy("_source").agg(
        F.map_from_entries(F.collect_list(entry)).alias("_all"))
    columns = sorted({*coerced, *urls})
    plans = plans.select("_source", F.struct(*[F.col("_all")[c].alias(c) for c in columns]).alias("_plan"))
    size = sum(facts[c].plan_bytes if c in facts else usage[c].source_bytes for c in columns if c in usage)
    rows = attach(kept.select("_source", "_row", "_key", *columns), plans, ["_source"], how="left", size=size)
    cells = []
    for c in coerced:
        plan, cell = F.col("_plan")[c], F.col(c)
        out, live = plan["out"], F.col("_plan")[c]["keep"] & cell.isNotNull()
        formats = facts[c].formats if c in facts else [None]
        bad_number = F.when(out == "double", V.number(cell).isNull()).when(out == "bigint", V.integer(cell).isNull())
        bad_date = F.when(out == "timestamp_ntz", parse_dates(cell, plan["format"], formats or [None]).isNull())
        reason = F.when(live & bad_number, NOT_A_NUMBER).when(live & bad_date, NOT_A_DATE)
        cells.append(F.struct(F.lit(named[c]).alias("column"), cell.alias("value"), reason.alias("reason")))
    for c in urls:
        lost = F.col("_plan")[c]["is_url"] & F.col("_key").isNull() & F.col(c).rlike(DIGITS)
        cells.append(F.struct(F.lit(named[c]).alias("column"), F.col(c).alias("value"), F.when(lost, NOT_A_KEY).alias("reason")))
    found = F.filter(F.array(*cells), lambda x: x["reason"].isNotNull())
    return rows.select(F.col("_source").alias("source_file"), F.col("_row").alias("row"), F.inline(found))


def _url_columns(staged: Staged) -> dict[str, str]:
    """The columns that some header takes its key from."""
    place = dict(zip(staged.names, staged.columns))
    return {place[h.url]: h.url for h in staged.headers if h.url}


def fill_counts(batch: Batch) -> DataFrame:
    """Rows (source_file, column, fill, filled, value): how many gaps of each column were filled, and with what."""
    filled = batch.decisions.filter("fill IS NOT NULL AND fate = 'keep'")
    value = F.coalesce("text", V.float_text(F.col("number")))
    return filled.select(
        F.col("_source").alias("source_file"), F.col("cleaned_column").alias("column"), "fill",
        F.col("missing").alias("filled"), value.alias("value"))


def report(decisions: DataFrame, staged: Staged) -> DataFrame:
    """Rows (source_file, position, original_column, missing_percent_before, cleaned_column,
    action, details), one per original column of every file, and one for the key."""
    c = F.col
    fill = F.when(
        c("fill") == "median", F.format_string("Filled with median (%s)", V.float_text(c("number")))
    ).when(c("fill") == "mode", F.format_string("Filled with mode ('%s')", "text"))
    change = F.concat(F.lit("Type changed to "), c("change"))
    details = (
        F.when(c("fate") == "sparse", DROPPED_SPARSE)
        .when(c("fate") == "rule", DROPPED_RULE)
        .when(c("fate") == "key source", DROPPED_KEY)
        .otherwise(F.concat_ws(" | ", fill, change))
    )
    action = (
        F.when(c("fate").isin("sparse", "key source", "rule"), DROPPED)
        .when(c("fill").isNotNull(), FILLED)
        .otherwise(KEPT)
    )
    columns = decisions.select(
        c("_source").alias("source_file"), "position", "original_column",
        V.percent(c("raw_missing"), c("raw_rows")).alias("missing_percent_before"),
        "cleaned_column", action.alias("action"), details.alias("details"),
    )
    per_file = columns.groupBy("source_file").agg(
        (F.max("position") + 1).alias("position"),
        F.bool_or(c("cleaned_column") == KEY).alias("_has_key"),
    )
    key = per_file.filter(~c("_has_key")).select(
        "source_file", "position", F.lit(KEY).alias("original_column"),
        F.lit(0.0).alias("missing_percent_before"), F.lit(KEY).alias("cleaned_column"),
        F.lit(KEPT).alias("action"), F.lit("").alias("details"),
    )
    return columns.unionByName(key)


def status(data: DataFrame, decisions: DataFrame, staged: Staged) -> DataFrame:
    """One row per file: outcome, row counts at each step, keys found."""
    c = F.col
    cleaned = data.groupBy(SOURCE).agg(
        F.count(F.lit(1)).alias("cleaned_rows"), F.count(KEY).alias("keys_found"))
    profiled = decisions.groupBy(c("_source").alias(SOURCE)).agg(
        F.max("raw_rows").alias("raw_rows"), F.max("rows").alias("_rows"),
        F.count(F.lit(1)).cast("int").alias("n_columns"))
    counts = profiled.join(cleaned, SOURCE, "left").select(
        SOURCE, "raw_rows", (c("raw_rows") - c("_rows")).alias("summary_rows"),
        (c("_rows") - F.coalesce("cleaned_rows", F.lit(0))).alias("duplicate_rows"),
        F.coalesce("cleaned_rows", F.lit(0)).alias("cleaned_rows"),
        F.coalesce("keys_found", F.lit(0)).alias("keys_found"), "n_columns",
    )
    assessment = staged.extras.get("assessment")
    if assessment is None:
        return counts.withColumnRenamed(SOURCE, "file_name").select(
            "*", F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"))
    rejected = staged.extras["rejects"].groupBy("_source").agg(
        F.count(F.lit(1)).alias("rejected_rows"))
    files = assessment.select(
        c("_source").alias(SOURCE), "file_path", "size_mb", "working_encoding",
        "likely_delimiter", "issues_found", "error")
    joined = files.join(counts, SOURCE, "left").join(
        rejected.withColumnRenamed("_source", SOURCE), SOURCE, "left")
    return joined.fillna(0, ["rejected_rows"]).withColumn(
        "success", c("error").isNull()).withColumnRenamed(SOURCE, "file_name")
