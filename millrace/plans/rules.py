"""Cleaning rules as data: a table of rules, for all files or for those of a name pattern.

A rule is a row (file, kind, column, value). `file` is a LIKE pattern of file names, or null for
all files; `column` is a cleaned name.

    summary_word       value: a word of summary rows; a file with any has these instead of the usual
    sparse_percent     value: missing percent above which columns are dropped; of one column, if named
    numeric_min_share  value: least share of numbers that makes a text column numeric
    drop               column: is left out of the file
    rename             column: has the name `value` in the result; equal names are one column

Of several rules for one thing the longest pattern counts (a pattern before none), then the
greatest value. The table is compiled to one row per file, which is joined to that file's
statistics or rows; every column still has one expression, whatever the files' rules are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import KEY, SOURCE
from millrace.operators.attach import attach
from millrace.operators.merge import aligned_type
from millrace.operators.rows import SUMMARY_MIN_WORDS
from millrace.session import written
from millrace.sources.staging import Staged

RULES = "file string, kind string, column string, value string"
WORD, SPARSE, SHARE, DROP, RENAME = "summary_word", "sparse_percent", "numeric_min_share", "drop", "rename"
KINDS = (WORD, SPARSE, SHARE, DROP, RENAME)


def checked(rules: DataFrame) -> DataFrame:
    """The rules, in order of columns; a rule of unknown kind or without what it needs is an error."""
    rules = rules.select("file", "kind", "column", "value")
    kind, value = F.col("kind"), F.col("value")
    number = value.try_cast("double")
    wrong = (
        F.when(kind.isNull() | ~kind.isin(*KINDS), "unknown kind")
        .when(kind.isin(DROP, RENAME) & F.col("column").isNull(), "no column")
        .when(kind.isin(WORD, RENAME) & (F.coalesce(F.trim(value), F.lit("")) == ""), "no value")
        .when((kind == RENAME) & value.isin(KEY, SOURCE), "name is taken")
        .when((kind == SPARSE) & ~F.coalesce(number.between(0, 100), F.lit(False)), "not a percentage")
        .when((kind == SHARE) & ~F.coalesce(number.between(0, 1), F.lit(False)), "not a share")
    )
    bad = rules.withColumn("problem", wrong).filter("problem IS NOT NULL").orderBy("kind", "column", "value").first()
    if bad:
        raise ValueError(f"rule {bad['kind']} for column {bad['column']}: {bad['problem']}")
    return rules


def by_file(rules: DataFrame, staged: Staged) -> DataFrame:
    """One row per file with rules: (_source, words, sparse, column_sparse, share, dropped, renames)."""
    files = staged.files if staged.files is not None else staged.data
    files = files.select("_source").distinct()
    rules = written(checked(rules), "rules")
    # Files and rules are listings, not data.
    hit = files.join(rules, F.col("file").isNull() | F.expr("_source LIKE file"))
    rank = F.struct(F.coalesce(F.length("file"), F.lit(-1)), "value")
    single = hit.filter(F.col("kind") != WORD).groupBy("_source", "kind", "column").agg(F.max_by("value", rank).alias("value"))
    words = hit.filter(F.col("kind") == WORD).groupBy("_source").agg(F.collect_set(F.lower("value")).alias("words"))

    def one(kind: str) -> Column:
        return F.max(F.when((F.col("kind") == kind) & F.col("column").isNull(), F.col("value").try_cast("double")))

    def entries(kind: str) -> Column:
        return F.map_from_entries(F.collect_list(F.when((F.col("kind") == kind) & F.col("column").isNotNull(), F.struct("column", "value"))))

    singles = single.groupBy("_source").agg(
        one(SPARSE).alias("sparse"), entries(SPARSE).alias("column_sparse"), one(SHARE).alias("share"),
        F.collect_set(F.when(F.col("kind") == DROP, F.col("column"))).alias("dropped"), entries(RENAME).alias("renames"))
    table = singles.join(words, "_source", "full").select("_source", "words", "sparse", "column_sparse", "share", "dropped", "renames")
    return written(table, "file_rules")


def with_summaries(staged: Staged, table: DataFrame) -> Staged:
    """Summary rows by each file's own words."""
    own = table.filter("words IS NOT NULL").select("_source", F.col("words").alias("_words"))
    if own.isEmpty():
        return staged
    text = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in staged.columns]))
    rows = attach(staged.data, own, ["_source"], how="left").withColumn("_text", text)
    hits = F.size(F.filter("_words", lambda w: F.contains(F.col("_text"), w)))
    least = F.least(F.lit(SUMMARY_MIN_WORDS), F.size("_words"))
    summary = F.when(F.col("_words").isNull(), F.col("_summary")).otherwise(hits >= least)
    return replace(staged, data=rows.withColumn("_summary", summary).drop("_words", "_text"))


def renamed(data: DataFrame, table: DataFrame) -> DataFrame:
    """The result's columns under the names that each file's rules give them."""
    pairs = table.select("_source", F.explode("renames").alias("column", "value"))
    # One row per (old, new) name, whatever the number of files.
    names = [tuple(r) for r in pairs.select("column", "value").distinct().collect()]
    names = [(old, new) for old, new in names if old in data.columns and old not in (KEY, SOURCE) and old != new]
    if not names:
        return data
    kinds, moving = dict(data.dtypes), {}
    for old, new in sorted(names):
        moving.setdefault(new, []).append(old)
    rules = table.select(F.col("_source").alias(SOURCE), F.col("renames").alias("_renames"))
    rows = attach(data, rules, [SOURCE], how="left")
    out = [c for c in data.columns if c not in (KEY, SOURCE)] + [n for n in sorted(moving) if n not in data.columns]

    def stays(c: str) -> Column:
        return F.col("_renames").isNull() | ~F.coalesce(F.map_contains_key("_renames", c), F.lit(False)) | (F.col("_renames")[c] == c)

    def cell(name: str) -> Column | None:
        parts = [(old, F.col("_renames")[old] == name) for old in moving.get(name, ())]
        own = [(name, stays(name))] if name in data.columns else []
        kind = _common([kinds[c] for c, _ in own + parts])
        values = [F.when(test, F.col(f"`{c}`").cast(kind)) for c, test in own + parts]
        return F.coalesce(*values).alias(name)

    gone = _always_renamed(table, data, names)
    return rows.select(*[cell(c) for c in out if c not in gone], F.col(KEY), F.col(SOURCE))


def _always_renamed(table: DataFrame, data: DataFrame, names: Sequence[tuple[str, str]]) -> set[str]:
    """Columns that are empty once renamed, as every file that has rows renames them; names that others take stay."""
    taken = {new for _, new in names}
    olds = sorted({old for old, _ in names} - taken)
    if not olds:
        return set()
    rows = attach(data.select(SOURCE, *[F.col(f"`{c}`").isNotNull().alias(f"_{i}") for i, c in enumerate(olds)]),
                  table.select(F.col("_source").alias(SOURCE), F.col("renames").alias("_renames")), [SOURCE], how="left")
    kept = rows.agg(*[
        F.bool_or(F.col(f"_{i}") & ~F.coalesce(F.map_contains_key("_renames", c), F.lit(False))).alias(c) for i, c in enumerate(olds)]).first()
    return {c for c in olds if not kept[c]}


def _common(kinds: Sequence[str]) -> str:
    return kinds[0] if len(set(kinds)) == 1 else aligned_type(sorted(set(kinds)))
