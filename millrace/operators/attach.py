"""Adding one table row per group to every row of that group, whatever the group's size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table is broadcast only when its measured size, as JSON text, stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Beyond that, each group's rows are spread over this many join keys.
SALTS = 64


def same(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    """Whether the keys are equal, nulls among them; without keys all rows are."""
    return reduce(and_, [left[a].eqNullSafe(right[b]) for a, b in zip(left_keys, right_keys)] or [F.lit(True)])


def text_bytes(table: DataFrame) -> int:
    """Size of a small written table: the bytes of all its rows as JSON."""
    row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])))
    return table.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def attach(
    rows: DataFrame,
    table: DataFrame,
    by: Sequence[str],
    how: str = "inner",
    broadcast_bytes: int | None = None,
    size: int | None = None,
) -> DataFrame:
    """Join `table` (one row per `by`) to `rows`; null groups match.

    Without `by`, all rows are one group, and the table's one row goes to each.
    The table's size is measured, unless the caller has counted its bytes.
    """
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    keys = [f"_attach_{b}" for b in by]
    values = [c for c in table.columns if c not in by]
    keyed = table.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], *values)
    if (text_bytes(table) if size is None else size) <= limit:
        joined = rows.join(F.broadcast(keyed), same(rows, keyed, by, keys), how)
        return joined.drop(*keys)
    salted = rows.withColumn("_salt", F.spark_partition_id() % SALTS)
    copies = keyed.withColumn("_salt_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    match = same(salted, copies, [*by, "_salt"], [*keys, "_salt_copy"])
    return salted.join(copies, match, how).drop("_salt", "_salt_copy", *keys)
