"""Exact medians and modes per group and column, and filling with them.

A group may hold a third of all rows, so neither statistic keeps one group's values in
one task. Modes count values under (group, column, value) first and compare counts
after. Medians are bracketed with a mergeable quantile sketch; only the few values
inside the bracket are counted, and the rank is read off those counts. The bracket is
checked, not trusted: a group whose middle ranks fall outside it is redone in full.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.functions.values import present
from millrace.operators.attach import attach, same
from millrace.session import written

# Up to this many cells (rows of the largest group times columns) the built-in median,
# whose buffer is a value-to-count map, is bounded well enough.
BUILTIN_MEDIAN_CELLS = 250_000
# Distinct values of one (group, column) that one task may put in order.
ORDERED_VALUES = 1_000_000
SKETCH_ACCURACY = 1_000
# Fan-out of one narrowing round over the distinct values.
NARROW_CUTS = 64


def exact_modes(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, mode): most frequent non-null text, smallest on ties."""
    cells = _cells(df, columns, by).filter("value IS NOT NULL")
    counts = cells.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("_times"))
    return counts.groupBy(*by, "column").agg(
        F.min_by("value", F.struct(-F.col("_times"), F.col("value"))).alias("mode")
    )


def exact_medians(
    df: DataFrame,
    columns: Mapping[str, Column],
    by: Sequence[str] = (),
    max_group_rows: int | None = None,
) -> DataFrame:
    """Rows (by..., column, median), the mean of the two middle values of the non-nulls.

    `max_group_rows` is the row count of the largest group, counted here if not given.
    """
    if max_group_rows is None:
        sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        max_group_rows = sizes.agg(F.max("n")).first()[0] or 0
    if max_group_rows * len(columns) <= BUILTIN_MEDIAN_CELLS:
        names = list(columns)
        wide = df.groupBy(*by).agg(
            *[F.median(columns[c]).alias(f"_{i}") for i, c in enumerate(names)]
        )
        rows = F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("median"))
            for i, c in enumerate(names)
        ])
        return wide.select(*by, F.inline(rows)).filter("median IS NOT NULL")
    return bracketed_medians(df, columns, by, max_group_rows)


def bracketed_medians(
    df: DataFrame, columns: Mapping[str, Column], by: Sequence[str], max_group_rows: int
) -> DataFrame:
    keys = [*by, "column"]
    brackets = written(_brackets(df, columns, by), "brackets")
    counts = _bracket_counts(df, columns, by, brackets)
    # About 2 * margin / accuracy of the rows lie inside; round up generously.
    counts = _narrow_until_ordered(counts, keys, max_group_rows * 8 // SKETCH_ACCURACY + 16)
    medians = written(_read_medians(counts, keys).filter("median IS NOT NULL"), "medians")
    groups = brackets.select(*by, F.inline(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(f"_n_{i}").alias("_n"))
        for i, name in enumerate(columns)
    ]))).filter("_n > 0").drop("_n")
    missed = groups.join(medians, same(groups, medians, keys, keys), "left_anti")
    if missed.isEmpty():
        return medians
    full = _bracket_counts(df, columns, by, brackets, everything=True)
    full = full.join(missed, same(full, missed, keys, keys), "left_semi")
    full = _narrow_until_ordered(full, keys, max_group_rows)
    return medians.unionByName(_read_medians(full, keys))


def _narrow_until_ordered(counts: DataFrame, keys: Sequence[str], distinct: int) -> DataFrame:
    """Narrow until no (group, column) can hold more values than one task may order."""
    while distinct > ORDERED_VALUES:
        counts = written(_narrowed(written(counts, "counts"), keys), "narrowed")
        distinct = distinct * 4 // NARROW_CUTS + 1
    return counts


def _cells(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(name).alias("column"), value.alias("value"))
        for name, value in columns.items()
    ])
    return df.select(*by, F.inline(rows))


def _brackets(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """One row per group: of every column the count and two cuts around the middle."""
    margin = 3 / SKETCH_ACCURACY
    shares = [0.5 - margin, 0.5 + margin]
    return df.groupBy(*by).agg(*[
        measure
        for i, value in enumerate(columns.values())
        for measure in (
            F.count(value).alias(f"_n_{i}"),
            F.percentile_approx(value, shares, SKETCH_ACCURACY).alias(f"_cut_{i}"),
        )
    ])


def _bracket_counts(
    df: DataFrame,
    columns: Mapping[str, Column],
    by: Sequence[str],
    brackets: DataFrame,
    everything: bool = False,
) -> DataFrame:
    """Distinct values inside the bracket with their counts; all below it as one null value."""
    values = {f"_value_{i}": value for i, value in enumerate(columns.values())}
    rows = df.select(*by, *[value.alias(name) for name, value in values.items()])
    rows = attach(rows, brackets, by)
    cells = rows.select(*by, F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"_value_{i}").alias("value"),
            F.col(f"_n_{i}").alias("_n"),
            F.col(f"_cut_{i}")[0].alias("_low"),
            F.col(f"_cut_{i}")[1].alias("_high"),
        )
        for i, name in enumerate(columns)
    ]))).filter("value IS NOT NULL")
    value = F.col("value")
    if not everything:
        cells = cells.filter(value <= F.col("_high"))
        value = F.when(value >= F.col("_low"), value)
    counts = cells.groupBy(*by, "column", value.alias("value"), "_n").agg(
        F.count(F.lit(1)).alias("_times")
    )
    return counts.select(
        *by, "column", "value", "_times",
        F.expr("(_n + 1) div 2").alias("_low_rank"),
        F.expr("_n div 2 + 1").alias("_high_rank"),
        F.lit(0).cast("bigint").alias("_below"),
    )


def _narrowed(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep only the distinct values in the slices that hold the two middle ranks."""
    shares = [i / NARROW_CUTS for i in range(1, NARROW_CUTS)]
    cuts = counts.groupBy(*keys).agg(
        F.percentile_approx("value", shares, 10 * NARROW_CUTS).alias("_cuts")
    )
    sliced = attach(counts, written(cuts, "cuts"), keys).withColumn(
        "_slice", F.size(F.filter("_cuts", lambda x: x < F.col("value")))
    )
    totals = sliced.groupBy(*keys, "_slice", "_low_rank", "_high_rank").agg(
        F.sum("_times").alias("_total"), F.max("_below").alias("_start")
    )
    ordered = W.partitionBy(*keys).orderBy("_slice")
    totals = totals.withColumn("_upto", F.col("_start") + F.sum("_total").over(ordered))
    holds = totals.filter(
        (F.col("_low_rank") <= F.col("_upto"))
        & (F.col("_high_rank") > F.col("_upto") - F.col("_total"))
    )
    offsets = holds.groupBy(*keys).agg(
        F.min(F.col("_upto") - F.col("_total")).alias("_below"),
        F.min("_slice").alias("_first"),
        F.max("_slice").alias("_last"),
    )
    return (
        attach(sliced.drop("_below", "_cuts"), written(offsets, "offsets"), keys)
        .filter(F.col("_slice").between(F.col("_first"), F.col("_last")))
        .drop("_slice", "_first", "_last")
    )


def _read_medians(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The median from ordered counts; null where a middle rank lies outside the counts."""
    ordered = W.partitionBy(*keys).orderBy(F.col("value").asc_nulls_first())
    upto = F.col("_below") + F.sum("_times").over(ordered)
    ranked = counts.withColumn("_upto", upto).withColumn("_from", upto - F.col("_times"))

    def at(rank: str) -> Column:
        hit = (F.col(rank) > F.col("_from")) & (F.col(rank) <= F.col("_upto"))
        return F.max(F.when(hit, F.col("value")))

    return ranked.groupBy(*keys).agg(
        ((at("_low_rank") + at("_high_rank")) / 2).alias("median")
    )


def fill_missing(
    df: DataFrame,
    medians: Sequence[str] = (),
    modes: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Fill nulls of `medians` (to double) and `modes` (texts) with their group's statistic.

    NaN is missing too. The statistics are one row per group, at most, so they are attached
    by `by`.
    """
    value = {c: present(df, c).cast("double") for c in medians}
    stats = []
    if medians:
        stats.append(
            exact_medians(df, value, by)
            .select(*by, "column", F.col("median").alias("number"), F.lit(None).cast("string").alias("text"))
        )
    if modes:
        stats.append(
            exact_modes(df, {c: F.col(c) for c in modes}, by)
            .select(*by, "column", F.lit(None).cast("double").alias("number"), F.col("mode").alias("text"))
        )
    if not stats:
        return df
    long = reduce(DataFrame.unionByName, stats)
    wide = long.groupBy(*by).agg(
        *[F.max(F.when(F.col("column") == c, F.col("number"))).alias(f"_fill_{c}") for c in medians],
        *[F.max(F.when(F.col("column") == c, F.col("text"))).alias(f"_fill_{c}") for c in modes],
    )
    if by:
        joined = attach(df, written(wide, "fills"), by, how="left")
    else:
        found = wide.first().asDict()
        joined = df.select("*", *[F.lit(v).alias(c) for c, v in found.items()])
    filled = {
        **{c: F.coalesce(value[c], F.col(f"_fill_{c}")) for c in medians},
        **{c: F.coalesce(F.col(c), F.col(f"_fill_{c}")) for c in modes},
    }
    return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns])
