"""Joining a table of one row per key to rows, whichever of the two is large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.attach import same, text_bytes

#: A written table is broadcast only when its measured size, as JSON text, stays below this.
BROADCAST_BYTES = 48 * 1024 * 1024


def join_keyed(rows: DataFrame, table: DataFrame, by: Sequence[str], how: str = "left", limit: int = BROADCAST_BYTES) -> DataFrame:
    """`rows` with the columns of the written `table` (one row per `by`); null keys match.

    Up to `limit` measured bytes the table is broadcast and the rows stay where they are;
    beyond, and always if `limit` is 0, both are shuffled by the key, and adaptive execution
    splits hot keys of `rows`.
    """
    keys = [f"_key_{b}" for b in by]
    keyed = table.select(*[F.col(f"`{b}`").alias(k) for b, k in zip(by, keys)], *[F.col(f"`{c}`") for c in table.columns if c not in by])
    if limit and text_bytes(table) <= limit:
        keyed = F.broadcast(keyed)
    return rows.join(keyed, same(rows, keyed, [f"`{b}`" for b in by], keys), how).drop(*keys)
