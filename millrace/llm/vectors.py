"""Embedding near-duplicates by int8 tile products with error bounds, exact in double precision.

Vectors are compared inside a label (and length) only. Copies of one vector are one class
with a count. A label's classes are dealt by hash into tiles of TILE_ROWS; every pair of
tiles is a task, so a hot label is many tasks and no task holds more than two tiles.

In a task each unit vector x is quantised as s*q, q in int8, and what that misses, |x - s*q|,
is computed. The product of two int8 tiles then bounds each cosine from above:

    x.y <= s_x s_y q_x.q_y + |s_x q_x| |e_y| + |e_x|

The integer products are one matrix product in floating point, which is exact as long as the
sums stay within the mantissa. Only pairs whose bound reaches the threshold are computed again
in double precision, and those counts alone leave the task with a spanning forest of the
links, never the pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and those without a
label, link with nothing and are a component of their own. Repeated rows and ids are rows of
their own. A null id never names a component, unless all of its ids are null. Empty tables
give no rows. Other columns are carried along; helper names start with `_vec`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.graph import components, forest
from millrace.session import written

TILE_ROWS = 2048
#: Rows of a tile multiplied at once, and candidate pairs computed again at once.
BLOCK_ROWS = 256
EXACT_PAIRS = 1 << 16
#: Room for the rounding of the bounds, which are held in single precision.
SLACK = 1e-4


def usable(vector: Column) -> Column:
    """Not null, and all components finite and not null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """q (int8), scale s, |s*q| and the error |x - s*q| of each unit vector."""
    scale = np.abs(units).max(axis=1) / 127
    q = np.rint(units / scale[:, None]).astype(np.int8)
    near = scale[:, None] * q
    return q, scale, np.linalg.norm(near, axis=1), np.linalg.norm(units - near, axis=1)


def tile_links(left: np.ndarray, right: np.ndarray, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two tiles of unit vectors with cosine >= threshold; each pair once if they are the same tile."""
    exact = np.float32 if left.shape[1] * 127 * 127 < 1 << 24 else np.float64
    (ql, sl, nl, el), (qr, sr, _, er) = quantised(left), quantised(right)
    turned = qr.T.astype(exact)
    for at in range(0, len(left), BLOCK_ROWS):
        rows = slice(at, at + BLOCK_ROWS)
        bound = ql[rows].astype(exact) @ turned
        bound *= sl[rows, None].astype(exact)
        bound *= sr[None, :].astype(exact)
        bound += (nl[rows, None] * er[None, :] + el[rows, None]).astype(exact)
        i, j = np.nonzero(bound >= threshold - SLACK)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), EXACT_PAIRS):
            a, b = i[part : part + EXACT_PAIRS], j[part : part + EXACT_PAIRS]
            near = np.einsum("ij,ij->i", left[a], right[b]) >= threshold
            yield a[near], b[near]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def vector_components(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93, keep: list[str] | None = None) -> DataFrame:
    """`rows` (or only its columns `keep`) with `n_links` and `component_id`.

    `n_links`: other rows linked directly; `component_id`: the smallest id reachable.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    kept = [c for c in (rows.columns if keep is None else keep) if c not in ("n_links", "component_id")]
    v, tag = F.col(f"`{vector}`"), F.col(f"`{label}`")
    good = usable(v) & F.exists(v, lambda x: x != 0) & tag.isNotNull()
    numbered = rows.select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{id}`").alias("_vec_id"), v.alias("_vec"), tag.alias("_vec_label"),
        F.coalesce(good, F.lit(False)).alias("_vec_good"),
    )
    numbered = numbered.withColumn("_vec_a", F.xxhash64("_vec")).withColumn("_vec_b", F.xxhash64(F.lit(1), "_vec"))
    keys = ["_vec_label", "_vec_a", "_vec_b"]
    classes = numbered.where("_vec_good").groupBy(*keys).agg(
        F.min("_vec_id").alias("least"), F.count("*").alias("copies"), F.any_value("_vec").alias("_vec")
    )
    classes = classes.withColumn("size", F.size("_vec")).withColumn("node", F.monotonically_increasing_id())
    classes = written(classes, "vector_classes")
    tiles = classes.groupBy("_vec_label", "size").agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("tiles"))
    tiles = written(tiles, "vector_tiles")
    placed = classes.join(tiles, ["_vec_label", "size"]).withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    placed = placed.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.select("_vec_label", "size", F.least("t", "u").alias("x"), F.greatest("t", "u").alias("y"), "t", "node", "copies", "_vec")

    def compare(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        side = table.column("t").to_numpy() == x
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        units = unit(_matrix(table.column("_vec")))
        low = np.flatnonzero(side)
        high = low if x == y else np.flatnonzero(~side)
        links = np.zeros(len(node), dtype=np.int64)
        root = np.arange(len(node))
        if len(low) and len(high):
            for i, j in tile_links(units[low], units[high], x == y, threshold):
                i, j = low[i], high[j]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                root = forest(len(node), np.r_[np.arange(len(node)), i], np.r_[root, j])
        linked = links > 0
        return pa.table({"node": node[linked], "links": links[linked], "root": node[root[linked]]})

    found = placed.groupBy("_vec_label", "size", "x", "y").applyInArrow(compare, "node bigint, links bigint, root bigint")
    found = written(found, "vector_links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = classes.drop("_vec", "size").join(counts, "node", "left").join(roots, "node", "left")
    joined = written(joined.select(
        *keys, "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")
    ), "vector_joined")
    names = written(joined.groupBy("root").agg(F.min("least").alias("component_id")), "vector_names")
    named = written(joined.join(names, "root").select(*keys, "n_links", "component_id"), "vector_named")
    out = numbered.drop("_vec").join(named.withColumn("_vec_good", F.lit(True)), [*keys, "_vec_good"], "left")
    alone = F.when(F.col("_vec_good"), F.col("component_id")).otherwise(F.col("_vec_id"))
    return out.select(*[F.col(f"`{c}`") for c in kept], F.coalesce("n_links", F.lit(0)).alias("n_links"), alone.alias("component_id"))
