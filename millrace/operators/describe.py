"""Data profiles: counts, distinct values, quartiles, frequent values, and values beyond fences.

The first pass keeps one row of mergeable sketches per group (file) and column: counts, extremes,
HyperLogLog for distinct values, KLL for quantiles, and a table of frequent values. Sketches of
batches are kept and merged, so that a profile of everything never reads old batches again.
Where exact figures are asked for, further passes make them: quartiles inside the sketches'
brackets, then values beyond the fences (1.5 times the interquartile range away from the outer
quartiles), distinct values and the most frequent one. No task ever holds a group's values.

NaN is missing. Columns that are not numbers have no quantiles; extremes are of numbers in
`least` and `most`, of other values, as text, in `least_text` and `most_text`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import percent, present
from millrace.operators.attach import same
from millrace.operators.profile import long_aggregate
from millrace.operators.quantiles import attach_all, exact_quantiles, sketched
from millrace.session import written

#: Values that a table of frequent values has room for.
TRACKED = 1024
FENCE = 1.5
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _is_number(kind: str) -> bool:
    return kind.split("(")[0] in NUMBERS


def _numbers(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    kinds = dict(df.dtypes)
    return {c: present(df, c).cast("double") for c in columns if _is_number(kinds[c])}


def _text(df: DataFrame, c: str) -> Column:
    return present(df, c).cast("string")


def sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, rows, nulls, least, most, least_text, most_text, distinct, quantiles, frequent)."""
    columns = [c for c in (columns or df.columns) if c not in by]
    numbers = _numbers(df, columns)
    nothing = {k: F.lit(None).cast(k) for k in ("double", "string", "binary")}
    return long_aggregate(df, by, columns, {
        "rows": lambda c: F.count(F.lit(1)),
        "nulls": lambda c: F.count_if(present(df, c).isNull()),
        "least": lambda c: F.min(numbers[c]) if c in numbers else nothing["double"],
        "most": lambda c: F.max(numbers[c]) if c in numbers else nothing["double"],
        "least_text": lambda c: nothing["string"] if c in numbers else F.min(_text(df, c)),
        "most_text": lambda c: nothing["string"] if c in numbers else F.max(_text(df, c)),
        "distinct": lambda c: F.hll_sketch_agg(_text(df, c)),
        "quantiles": lambda c: sketched(numbers[c]) if c in numbers else nothing["binary"],
        "frequent": lambda c: F.expr(f"approx_top_k_accumulate({_quoted(df, c)}, {TRACKED})"),
    })


def _quoted(df: DataFrame, c: str) -> str:
    name = f"`{c.replace('`', '``')}`"
    if df.schema[c].dataType.typeName() in ("float", "double"):
        return f"CAST(CASE WHEN NOT isnan({name}) THEN {name} END AS STRING)"
    return f"CAST({name} AS STRING)"


def merged(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of several batches, or of several groups, as one per (by..., column)."""
    return parts.groupBy(*by, "column").agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls")],
        F.min("least").alias("least"), F.max("most").alias("most"),
        F.min("least_text").alias("least_text"), F.max("most_text").alias("most_text"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
    )


def estimates(found: DataFrame, top: int = 3) -> DataFrame:
    """The sketches' figures: `distinct` and quartiles are estimates, counts and extremes are exact."""
    has = F.kll_sketch_get_n_double("quantiles") > 0
    cut = lambda share: F.when(has, F.kll_sketch_get_quantile_double("quantiles", F.lit(share)))
    kept = [c for c in found.columns if c not in ("distinct", "quantiles", "frequent")]
    return found.select(
        *kept, percent(F.col("nulls"), F.col("rows")).alias("missing_percent"),
        F.hll_sketch_estimate("distinct").alias("distinct"),
        cut(0.25).alias("q1"), cut(0.5).alias("median"), cut(0.75).alias("q3"),
        F.expr(f"transform(approx_top_k_estimate(frequent, {top}), x -> struct(x.item AS value, x.count AS times))").alias("frequent"),
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), found: DataFrame | None = None) -> DataFrame:
    """Exact rows (by..., column, rows, nulls, distinct, least, most, least_text, most_text, q1, median, q3,
    low_fence, high_fence, outliers, top_value, top_times).

    `found` are sketches of the same rows, if there are any; else they are made. The most
    frequent value is the smallest text of those that are equally frequent.
    """
    columns = [c for c in (columns or df.columns) if c not in by]
    found = written(sketches(df, columns, by) if found is None else found, "sketches")
    numbers = _numbers(df, columns)
    keys = [*by, "column"]
    out = found.select(*keys, "rows", "nulls", "least", "most", "least_text", "most_text")
    out = _with(out, _values(df, columns, by), keys)
    if not numbers:
        nothing = F.lit(None).cast("double")
        return out.select(*out.columns[:-2], *[nothing.alias(c) for c in ("q1", "median", "q3", "low_fence", "high_fence")],
                          F.lit(None).cast("bigint").alias("outliers"), "top_value", "top_times")
    cuts = exact_quantiles(df, numbers, by, (0.25, 0.5, 0.75), found)
    at = lambda share: F.max(F.when(F.col("share") == share, F.col("value")))
    cuts = cuts.groupBy(*keys).agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    far = FENCE * (F.col("q3") - F.col("q1"))
    cuts = written(cuts.withColumns({"low_fence": F.col("q1") - far, "high_fence": F.col("q3") + far}), "fences")
    out = _with(_with(out, cuts, keys), _beyond(df, numbers, by, cuts), keys)
    first = [*keys, "rows", "nulls", "distinct", "least", "most", "least_text", "most_text", "q1", "median", "q3", "low_fence", "high_fence"]
    return out.select(*first, "outliers", "top_value", "top_times")


def _values(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., column, distinct, top_value, top_times), counted by value before any group comes together."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _text(df, c).alias("value")) for c in columns])
    counts = df.select(*by, F.inline(cells)).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("times"))
    known = F.col("value").isNotNull()
    best = F.min(F.when(known, F.struct((-F.col("times")).alias("n"), F.col("value").alias("value"))))
    return counts.groupBy(*by, "column").agg(F.count("value").alias("distinct"), best.alias("_best")).select(
        *by, "column", "distinct", F.col("_best.value").alias("top_value"), (-F.col("_best.n")).alias("top_times"))


def _beyond(df: DataFrame, numbers: Mapping[str, Column], by: Sequence[str], cuts: DataFrame) -> DataFrame:
    """(by..., column, outliers): one pass, counters side by side."""
    entry = F.struct("column", F.struct("low_fence", "high_fence"))
    plan = written(cuts.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias("_plan")), "fence_plan")
    values = {c: f"_value_{i}" for i, c in enumerate(numbers)}
    rows = df.select(*by, *[v.alias(values[c]) for c, v in numbers.items()])
    rows = attach_all(rows, plan, by)
    rows = rows.select(*by, *values.values(), *[F.col("_plan")[c].alias(f"_at_{i}") for i, c in enumerate(numbers)])
    wide = rows.groupBy(*by).agg(*[
        F.count_if((F.col(v) < F.col(f"_at_{i}.low_fence")) | (F.col(v) > F.col(f"_at_{i}.high_fence"))).alias(f"_n_{i}")
        for i, v in enumerate(values.values())])
    return wide.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_n_{i}").alias("outliers")) for i, c in enumerate(numbers)])))


def _with(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.toDF(*[f"_r_{c}" if c in keys else c for c in right.columns])
    return left.join(renamed, same(left, renamed, keys, [f"_r_{k}" for k in keys]), "left").drop(*[f"_r_{k}" for k in keys])
