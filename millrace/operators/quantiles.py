"""Exact quantiles per group and column, found inside brackets of a mergeable sketch.

A sketch of a column (KLL) gives, for every share, two values that the quantile lies between.
One pass counts what is below each bracket, without multiplying rows; only the few values
inside brackets become rows of their own, are counted by value, and the rank is read off those
counts. Whether a bracket holds its ranks is checked; one that does not is widened to everything.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.attach import attach, same
from millrace.operators.fills import _narrow_until_ordered
from millrace.session import written

#: Size of a sketch, and a multiple of its rank error (about 0.26 % at this size).
SKETCH_SIZE = 1024
MARGIN = 0.01
#: Columns of so few values are counted whole.
WHOLE_ROWS = 1000


def sketched(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, SKETCH_SIZE)


def exact_quantiles(
    df: DataFrame, columns: Mapping[str, Column], by: Sequence[str] = (), shares: Sequence[float] = (0.25, 0.5, 0.75),
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Rows (by..., column, share, value): quantiles of the non-null values, interpolated linearly.

    `sketches`, if there are any, are rows (by..., column, quantiles) with a sketch of every column.
    """
    if sketches is None:
        wide = df.groupBy(*by).agg(*[sketched(v).alias(f"_{i}") for i, v in enumerate(columns.values())])
        sketches = wide.select(*by, F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("quantiles")) for i, c in enumerate(columns)])))
    brackets = written(_brackets(sketches.filter(F.col("column").isin(list(columns))), by, shares), "brackets")
    most = brackets.agg(F.max("_n")).first()[0] or 0
    if not most:
        return _read(brackets, by).limit(0)
    keys = [*by, "column", "_share"]
    found = written(_counted(df, columns, by, brackets, shares), "inside")
    exact = written(_read(_narrow_until_ordered(found, keys, int(most * 3 * abs(MARGIN)) + WHOLE_ROWS), by), "quantiles")
    asked = brackets.select(*by, "column", F.col("_share").alias("share"))
    missed = written(asked.join(exact, same(asked, exact, [*by, "column", "share"], [*by, "column", "share"]), "left_anti"), "missed")
    if missed.isEmpty():
        return exact
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    missed = missed.withColumnRenamed("share", "_share")
    again = brackets.join(missed, same(brackets, missed, keys, keys), "left_semi")
    everything = _counted(df, columns, by, again.withColumns({"_low": low, "_high": high}), shares)
    return exact.unionByName(_read(_narrow_until_ordered(everything, keys, most), by))


def attach_all(rows: DataFrame, table: DataFrame, by: Sequence[str]) -> DataFrame:
    """As `attach`; without `by`, the table's one row goes to every row."""
    if by:
        return attach(rows, table, by)
    return attach(rows.withColumn("_all", F.lit(0)), table.withColumn("_all", F.lit(0)), ["_all"]).drop("_all")


def _brackets(sketches: DataFrame, by: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Rows (by..., column, _share, _n, _low, _high); columns without values have none."""
    n = F.kll_sketch_get_n_double("quantiles")
    counted = sketches.filter("quantiles IS NOT NULL").withColumn("_n", n).filter("_n > 0")
    cut = lambda rank: F.kll_sketch_get_quantile_double("quantiles", F.lit(min(max(rank, 0.0), 1.0)))
    rows = F.array(*[F.struct(F.lit(float(s)).alias("_share"), cut(s - MARGIN).alias("_low"), cut(s + MARGIN).alias("_high")) for s in shares])
    # In a small group the bracket may be a single value, though the quantile lies between two.
    small = F.col("_n") <= WHOLE_ROWS
    return counted.select(*by, "column", "_n", F.inline(rows)).select(
        *by, "column", "_share", "_n",
        F.when(small, float("-inf")).otherwise(F.col("_low")).alias("_low"), F.when(small, float("inf")).otherwise(F.col("_high")).alias("_high"))


def _counted(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str], brackets: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Values inside the brackets with their counts, and how many values are below each bracket."""
    plan = brackets.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("\u0000", "column", F.col("_share").cast("string")), F.struct("_low", "_high", "_n")))).alias("_plan"))
    cells = [(c, float(s)) for c in columns for s in shares]
    values = {c: f"_value_{i}" for i, c in enumerate(columns)}
    rows = df.select(*by, *[v.cast("double").alias(values[c]) for c, v in columns.items()])
    rows = attach_all(rows, written(plan, "plan"), by)
    rows = rows.select(*by, *values.values(), *[
        F.col("_plan")[F.concat_ws("\u0000", F.lit(c), F.lit(s).cast("string"))].alias(f"_at_{k}") for k, (c, s) in enumerate(cells)])
    below = rows.groupBy(*by).agg(*[
        F.count_if(F.col(values[c]) < F.col(f"_at_{k}._low")).alias(f"_below_{k}") for k, (c, _) in enumerate(cells)])
    below = below.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("_share"), F.col(f"_below_{k}").alias("_below")) for k, (c, s) in enumerate(cells)])))
    inside = F.filter(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("_share"), F.col(values[c]).alias("value"),
                 F.col(values[c]).between(F.col(f"_at_{k}._low"), F.col(f"_at_{k}._high")).alias("_in"))
        for k, (c, s) in enumerate(cells)]), lambda x: x["_in"])
    counts = rows.select(*by, F.inline(inside)).groupBy(*by, "column", "_share", "value").agg(F.count(F.lit(1)).alias("_times"))
    keys = [*by, "column", "_share"]
    facts = written(_joined(below, brackets.select(*keys, "_n"), keys), "facts")
    place = (F.col("_n") - 1) * F.col("_share")
    return attach(counts, facts, keys).select(
        *keys, "value", "_times", (F.floor(place) + 1).alias("_low_rank"), (F.ceil(place) + 1).alias("_high_rank"),
        "_below", (place - F.floor(place)).alias("_part"))


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.toDF(*[f"_r_{c}" if c in keys else c for c in right.columns])
    return left.join(renamed, same(left, renamed, keys, [f"_r_{k}" for k in keys])).drop(*[f"_r_{k}" for k in keys])


def _read(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The quantile from ordered counts; no row where a rank lies outside of them."""
    keys = [*by, "column", "_share"]
    if "value" not in counts.columns:
        return counts.select(*by, "column", F.col("_share").alias("share"), F.lit(None).cast("double").alias("value"))
    upto = F.col("_below") + F.sum("_times").over(W.partitionBy(*keys).orderBy("value"))
    ranked = counts.withColumn("_upto", upto).withColumn("_from", upto - F.col("_times"))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) > F.col("_from")) & (F.col(rank) <= F.col("_upto")), F.col("value")))

    found = ranked.groupBy(*keys).agg(at("_low_rank").alias("_a"), at("_high_rank").alias("_b"), F.max("_part").alias("_part"))
    value = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") * (1 - F.col("_part")) + F.col("_b") * F.col("_part"))
    return found.select(*by, "column", F.col("_share").alias("share"), value.alias("value")).filter("value IS NOT NULL")
