"""Schema drift: columns of new data against a versioned baseline.

A snapshot has one row per group (a file, a source) and column: its place, the narrowest type
that all its values fit, counts, and a mergeable sketch of its set of values. Snapshots are
kept as numbered versions of a table. Drift is a full outer join of two snapshots on (group,
column), read off a lattice of types:

    empty < whole < number < text      empty < boolean < text      empty < date < timestamp < text

A type above the old one has been widened, one below narrowed, any other changed. A removed and
an added column of one group are a rename if their sets of values are alike: their sketches'
intersection against their union. Each side takes its best partner, and only pairs that choose
each other count, so that a column is renamed once. Only types that are comparable are paired,
and rows here are columns of headers: data is read once, for the snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import values as V
from millrace.functions.values import nullify, present
from millrace.operators.attach import same
from millrace.operators.profile import long_aggregate

# Types, and the types above each.
EMPTY, WHOLE, NUMBER, BOOLEAN, DATE, TIMESTAMP, TEXT = "empty", "whole", "number", "boolean", "date", "timestamp", "text"
ABOVE = {
    EMPTY: (WHOLE, NUMBER, BOOLEAN, DATE, TIMESTAMP, TEXT),
    WHOLE: (NUMBER, TEXT), NUMBER: (TEXT,), BOOLEAN: (TEXT,), DATE: (TIMESTAMP, TEXT), TIMESTAMP: (TEXT,), TEXT: (),
}
# What became of a column.
ADDED, REMOVED, WIDENED, NARROWED, CHANGED, RENAMED, KEPT = "added", "removed", "widened", "narrowed", "changed", "renamed", "kept"
#: Share of common values from which a removed and an added column are one.
ALIKE = 0.8

_TYPED = {
    "tinyint": WHOLE, "smallint": WHOLE, "int": WHOLE, "bigint": WHOLE, "float": NUMBER, "double": NUMBER,
    "boolean": BOOLEAN, "date": DATE, "timestamp": TIMESTAMP, "timestamp_ntz": TIMESTAMP,
}


def snapshot(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (by..., column, position, type, rows, nulls, value_set); text is typed by its values.

    A column without values in a group is `empty`. Missing tokens and NaN are missing.
    """
    columns = [c for c in (columns or df.columns) if c not in by]
    kinds = dict(df.dtypes)
    cells = {c: nullify(c) if kinds[c] == "string" else present(df, c) for c in columns}
    level = {c: V.cell_class(cells[c]) for c in columns if kinds[c] == "string"}

    def most(c: str, bound: int) -> Column:
        """How many values are numbers, whole numbers or booleans."""
        if c not in level:
            return F.lit(0).cast("bigint")
        return F.count_if(level[c] == bound if bound != V.NUMBER else level[c] >= V.NUMBER)

    found = long_aggregate(df, by, columns, {
        "rows": lambda c: F.count(F.lit(1)),
        "nulls": lambda c: F.count_if(cells[c].isNull()),
        "_whole": lambda c: most(c, V.WHOLE),
        "_number": lambda c: most(c, V.NUMBER),
        "_boolean": lambda c: most(c, V.BOOLEAN),
        "value_set": lambda c: F.theta_sketch_agg(cells[c].cast("string")),
    })
    there, one = F.col("rows") - F.col("nulls"), F.col("column")
    fixed = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit("" if kinds[c] == "string" else _typed(kinds[c])))])[one]
    read = F.when(F.col("_whole") == there, WHOLE).when(F.col("_number") == there, NUMBER).when(F.col("_boolean") == there, BOOLEAN).otherwise(TEXT)
    kind = F.when(there == 0, EMPTY).when(fixed != "", fixed).otherwise(read)
    place = F.array_position(F.lit(list(columns)), one).cast("int") - 1
    return found.select(*by, "column", place.alias("position"), kind.alias("type"), "rows", "nulls", "value_set")


def _typed(kind: str) -> str:
    return _TYPED.get(kind, NUMBER if kind.startswith("decimal") else TEXT)


def save_snapshot(found: DataFrame, folder: str) -> int:
    """Keep a snapshot as the next version below `folder`, and return its number.

    A version is a folder that a finished write has marked; one that was lost is written again.
    """
    spark = found.sparkSession
    number = max(versions(spark, folder), default=-1) + 1
    found.write.mode("overwrite").parquet(f"{folder}/version={number}")
    return number


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the finished versions, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path)]
    done = [n for n in names if n.startswith("version=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("version=")) for n in done)


def load_snapshot(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version of the snapshots below `folder`; the last one, if none is named."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no version {'at all' if version is None else version} in {folder}")
    return spark.read.parquet(f"{folder}/version={known[-1] if version is None else version}")


def drift(old: DataFrame, new: DataFrame, by: Sequence[str] = (), alike: float = ALIKE) -> DataFrame:
    """Rows (by..., column, change, old_column, old_type, new_type, old_position, new_position, similarity).

    One row per column of either snapshot; a renamed column has one, under its new name.
    """
    facts = ["position", "type", "value_set"]
    before = old.select(*[F.col(b).alias(f"_old_{b}") for b in by], F.col("column").alias("_old_column"), *[F.col(c).alias(f"old_{c}") for c in facts])
    after = new.select(*by, "column", *[F.col(c).alias(f"new_{c}") for c in facts])
    joined = before.join(after, same(before, after, [*[f"_old_{b}" for b in by], "_old_column"], [*by, "column"]), "full")
    groups = [F.coalesce(F.col(b), F.col(f"_old_{b}")).alias(b) for b in by]
    both = joined.select(*groups, F.col("column").alias("_new_column"), "_old_column", *[f"{w}_{c}" for w in ("old", "new") for c in facts])
    added, removed = F.col("_old_column").isNull(), F.col("_new_column").isNull()
    kept = both.filter(~added & ~removed)
    lost = both.filter(removed).select(*by, "_old_column", *[f"old_{c}" for c in facts])
    fresh = both.filter(added).select(*by, "_new_column", *[f"new_{c}" for c in facts])
    pairs = _renamed(lost, fresh, by, alike)
    lost = _left_over(lost, pairs, by, "_old_column")
    fresh = _left_over(fresh, pairs, by, "_new_column")
    order = [*by, "_old_column", "_new_column", "old_type", "new_type", "old_position", "new_position", "similarity", "change"]
    nothing = F.lit(None)

    def filled(frame: DataFrame, **more: Column) -> DataFrame:
        return frame.withColumns(more).select(*order)

    void = {"type": "string", "position": "int"}
    parts = [
        filled(kept, similarity=nothing.cast("double"), change=_change(F.col("old_type"), F.col("new_type"))),
        filled(pairs, change=F.lit(RENAMED)),
        filled(lost, _new_column=nothing.cast("string"), similarity=nothing.cast("double"), change=F.lit(REMOVED), **{f"new_{c}": nothing.cast(k) for c, k in void.items()}),
        filled(fresh, _old_column=nothing.cast("string"), similarity=nothing.cast("double"), change=F.lit(ADDED), **{f"old_{c}": nothing.cast(k) for c, k in void.items()}),
    ]
    found = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return found.select(
        *by, F.coalesce("_new_column", "_old_column").alias("column"), "change", F.col("_old_column").alias("old_column"),
        "old_type", "new_type", "old_position", "new_position", "similarity")


def _above(low: Column, high: Column) -> Column:
    test = F.lit(False)
    for kind, above in ABOVE.items():
        if above:
            test = test | ((low == kind) & high.isin(*above))
    return test


def _change(old: Column, new: Column) -> Column:
    return F.when(old == new, KEPT).when(_above(old, new), WIDENED).when(_above(new, old), NARROWED).otherwise(CHANGED)


def _renamed(lost: DataFrame, fresh: DataFrame, by: Sequence[str], alike: float) -> DataFrame:
    """Pairs of a group's removed and added columns that are each other's best partner."""
    right = fresh.toDF(*[f"_r_{c}" if c in by else c for c in fresh.columns])
    old, new = F.col("old_type"), F.col("new_type")
    fits = (old == new) | _above(old, new) | _above(new, old)
    match = same(lost, right, list(by), [f"_r_{b}" for b in by]) if by else F.lit(True)
    both = lost.join(right, match & (old != EMPTY) & (new != EMPTY) & fits)
    common = F.theta_sketch_estimate(F.theta_intersection("old_value_set", "new_value_set"))
    every = F.theta_sketch_estimate(F.theta_union("old_value_set", "new_value_set"))
    both = both.withColumn("similarity", common / every).filter(F.col("similarity") >= alike)
    order = [F.desc("similarity"), F.abs(F.col("old_position") - F.col("new_position")), "old_position", "new_position"]
    first = lambda c: F.row_number().over(W.partitionBy(*by, c).orderBy(*order))
    both = both.withColumns({"_of_old": first("_old_column"), "_of_new": first("_new_column")})
    return both.filter("_of_old = 1 AND _of_new = 1").drop("_of_old", "_of_new", "old_value_set", "new_value_set", *[f"_r_{b}" for b in by])


def _left_over(rows: DataFrame, pairs: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    taken = pairs.select(*[F.col(b).alias(f"_t_{b}") for b in by], F.col(column).alias("_t_column"))
    match = same(rows, taken, [*by, column], [*[f"_t_{b}" for b in by], "_t_column"])
    return rows.join(taken, match, "left_anti")
