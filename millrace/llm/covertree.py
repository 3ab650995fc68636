"""Exact top-k inner products by a dual-tree search over cover trees.

The top level of the tree over all rows is made by pivots, rows of a bounded sample: a row is of
its nearest pivot, and a pivot covers its rows by their largest distance. A query is sent to
the rows of a pivot only if the bound below allows one of them among its k best. That is
done in two rounds: first every query goes to the pivot of the highest product, which lifts its
worst k-th score; then to all others that may still beat that score. A pivot's rows and the
queries that come to it are dealt into blocks by hash; each pair of them is a task of bounded
size, which indexes both in cover trees and traverses them together. A node covers its points
by a centre and a radius, so for queries q within r of a and points x within s of b

    q.x <= a.b + r |b| + s |a| + r s

and a pair of nodes is dropped if that is below the worst k-th score of the node's queries.
These scores start from the sample, sent to all tasks, that every query is compared with: only
rows that can be among a query's k best leave a task, and a ranking per query, limited to k
rows before the shuffle, merges them. Where vectors have no structure, no bound drops anything,
and every query meets every row.

Components are integers, so scores are exact: in double precision while sums stay below
2**53, beyond that in unbounded integers (compared one by one; scores outside the range of a
long are its ends).

Vectors that are null or hold null or non-finite components take no part, nor do rows
without id. Vectors of other lengths than the query's are not compared with it. A query's own
row is every row of its id. Repeated query rows each get their result. Ties go to the smaller
id. Empty tables give no rows; columns other than id and vector are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.joins import join_keyed
from millrace.llm.vectors import usable
from millrace.session import written

BLOCK_ROWS, BLOCK_QUERIES = 2048, 2048
#: Rows that every query is compared with first; the pivots are some of them, one for BLOCK_ROWS rows.
SEED_ROWS = 1024
#: Of the lengths of vectors, bounds are widened by so much for what rounding may take.
SLACK = 1e-9
#: A child's radius is its parent's divided by this; nodes of so few queries are leaves.
SCALE, LEAF_QUERIES = 1.5, 16
_EXACT = 2.0**53


class CoverTree:
    """Nodes as arrays: centre row, radius, points (a range of `order`) and children (a range of nodes)."""

    def __init__(self, points: np.ndarray, leaf: int = 1):
        self.points = points
        centre, radius, low, high, first, last = [], [], [], [], [], []
        order = np.arange(len(points))
        squares = (points * points).sum(axis=1)

        def distances(of: np.ndarray, one: np.ndarray, square: float) -> np.ndarray:
            return np.sqrt(np.maximum(squares[of] + square - 2 * (points[of] @ one), 0))

        queue = [(0, len(points))]
        at = 0
        while at < len(queue):
            a, b = queue[at]
            at += 1
            low.append(a), high.append(b), first.append(len(queue))
            if b - a == 1:
                centre.append(order[a]), radius.append(0.0), last.append(len(queue))
                continue
            own = order[a:b].copy()
            mean = points[own].mean(axis=0)
            middle = own[np.argmin(distances(own, mean, mean @ mean))]
            far = distances(own, points[middle], squares[middle]).max()
            centre.append(middle), radius.append(far)
            if b - a > leaf and far > 0:
                # Children cover the node: the first takes what is near the centre, each other what is near
                # the first point not yet covered. The farthest point is never near the centre, so
                # every child is smaller than its node.
                reach, place, rest, pivot = far / SCALE, a, own, middle
                while len(rest):
                    near = (distances(rest, points[pivot], squares[pivot]) <= reach) | (rest == pivot)
                    part = rest[near]
                    order[place : place + len(part)] = part
                    queue.append((place, place + len(part)))
                    place, rest = place + len(part), rest[~near]
                    pivot = rest[0] if len(rest) else pivot
                assert len(queue) - first[-1] > 1
            last.append(len(queue))
        self.order = order
        self.centre, self.low, self.high = np.array(centre), np.array(low), np.array(high)
        self.first, self.last = np.array(first), np.array(last)
        self.radius = np.array(radius) * (1 + 1e-9)
        self.norm = np.sqrt((points[self.centre] ** 2).sum(axis=1)) * (1 + 1e-9)

    def spread(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        size = high - low
        return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Best:
    """The k best (score, id) so far of each query, the worst first to be beaten."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k, self.floor = ids, k, floor.copy()
        self.scores = [np.empty(0)] * len(ids)
        self.found = [np.empty(0, np.int64)] * len(ids)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        take = (scores >= self.floor[query]) & (ids != self.ids[query])
        if not take.any():
            return
        scores, ids = np.r_[self.scores[query], scores[take]], np.r_[self.found[query], ids[take]]
        if len(scores) > self.k:
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[scores >= edge], ids[scores >= edge]
            place = np.lexsort((ids, -scores))[: self.k]
            scores, ids = scores[place], ids[place]
        self.scores[query], self.found[query] = scores, ids
        if len(scores) == self.k:
            self.floor[query] = max(self.floor[query], scores.min())


def dual_search(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Offer `best` every point that can be among a query's k best."""
    left, right = CoverTree(queries, LEAF_QUERIES), CoverTree(points)
    stack = [(0, np.array([0]))]
    while stack:
        node, others = stack.pop()
        own = left.order[left.low[node] : left.high[node]]
        a, r, size = queries[left.centre[node]], left.radius[node], left.norm[node]
        leaf = left.first[node] == left.last[node]
        reached = []
        while len(others):
            bound = points[right.centre[others]] @ a
            bound += r * right.norm[others] + right.radius[others] * (size + r)
            bound += 1e-9 * np.abs(bound)
            others = others[bound >= best.floor[own].min()]
            open_ = right.first[others] < right.last[others]
            if not leaf:
                open_ &= right.radius[others] > r
            reached.append(others[~open_])
            inner = others[open_]
            others = right.spread(right.first[inner], right.last[inner])
        others = np.concatenate(reached) if reached else others
        if not len(others):
            continue
        if leaf:
            rows = right.order[right.spread(right.low[others], right.high[others])]
            scores = queries[own] @ points[rows].T
            for i, query in enumerate(own):
                best.add(query, scores[i], ids[rows])
        else:
            stack.extend((child, others) for child in range(left.first[node], left.last[node]))


def _wide_search(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """The same for components so large that sums leave the doubles' integers: one by one."""
    whole = [[int(x) for x in p] for p in points]
    limit = 2**63
    for i, query in enumerate(queries):
        q = [int(x) for x in query]
        scores = [max(-limit, min(limit - 1, sum(a * b for a, b in zip(q, p)))) for p in whole]
        best.add(i, np.array(scores, dtype=object), ids)


def _matrix(column) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)


def _wide(*matrices: np.ndarray) -> bool:
    most = [np.abs(m).max(initial=0) for m in matrices]
    return max(most) ** 2 * matrices[0].shape[1] * 4 >= _EXACT


def top_products(rows: DataFrame, queries: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of `queries` its `k` best rows of `rows`.

    Components are floor(scale * x); ids are integers.
    """
    v = F.col(f"`{vector}`")
    # Floored as doubles: a component may be beyond the range of a long.
    def floored(x):
        y = F.lit(scale) * x.cast("double")
        return F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)

    whole = F.transform(v, floored)
    ready = lambda frame: frame.where(usable(v) & F.col(f"`{id}`").isNotNull()).select(
        F.col(f"`{id}`").cast("bigint").alias("id"), whole.alias("v"), F.size(v).alias("size")
    ).where("size > 0")
    points = written(ready(rows), "product_points")
    asked = written(ready(queries).withColumn("row", F.monotonically_increasing_id()), "product_queries")
    counts = {r["size"]: r["count"] for r in points.groupBy("size").count().collect()}
    seeds = points.orderBy(F.xxhash64("id"), "id", "v").limit(SEED_ROWS).toPandas()
    by_size = {}
    for size, group in seeds.groupby("size"):
        vectors = np.stack(group["v"].to_numpy())
        pivots = vectors[np.sort(np.unique(vectors, axis=0, return_index=True)[1])][: -(-counts[size] // BLOCK_ROWS)]
        by_size[int(size)] = vectors, group["id"].to_numpy(), pivots
    sent = rows.sparkSession.sparkContext.broadcast(by_size)
    kind = dict(points.dtypes)["v"]
    near = points.mapInArrow(_assigned(sent), f"id bigint, v {kind}, size int, pivot int, away double")
    covers = written(near.groupBy("size", "pivot").agg(F.max("away").alias("away"), F.count("*").alias("rows")), "product_pivots")
    # At most a sample's rows for each length of vectors.
    radius = {(r["size"], r["pivot"]): r["away"] for r in covers.select("size", "pivot", "away").collect()}
    cover = rows.sparkSession.sparkContext.broadcast(radius)
    schema = f"id bigint, v {kind}, size int, row bigint, floor double, pivots array<int>"
    first = asked.mapInArrow(_visits(sent, cover, k, first=True), schema)
    best = written(_searched(first, near, covers, k, kind), "product_first")
    # A query's floor is its worst k-th score so far.
    scores = written(best.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("floor")), "product_floors")
    rest = join_keyed(asked, scores, ["row"]).select("id", "v", "size", "row", "floor")
    rest = rest.mapInArrow(_visits(sent, cover, k, first=False), schema)
    found = best.union(_searched(rest, near, covers, k, kind))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _sized(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, vectors) of a batch's rows of each length."""
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        here = np.flatnonzero(sizes == size)
        yield int(size), here, _matrix(batch.column("v").take(pa.array(here)))


def _assigned(sent):
    """Rows with their nearest pivot and the distance from it; without a pivot of that length, infinitely far from number 0."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, away = np.zeros(batch.num_rows, dtype=np.int32), np.full(batch.num_rows, np.inf)
            for size, here, mine in _sized(batch):
                if size in sent.value:
                    centres = sent.value[size][2]
                    square = (centres * centres).sum(axis=1)
                    pivot[here] = np.argmin(square[None, :] - 2 * (mine @ centres.T), axis=1)
                    away[here] = np.sqrt(((mine - centres[pivot[here]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(pivot), pa.array(away)], names=["id", "v", "size", "pivot", "away"])

    return step


def _visits(sent, cover, k: int, first: bool):
    """Queries with their floor and the pivots whose rows may beat it: at `first`, the one of the highest product, later all others."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floor = np.full(batch.num_rows, -np.inf)
            if not first:
                floor = batch.column("floor").fill_null(-np.inf).to_numpy(zero_copy_only=False).copy()
            ids, pivots = batch.column("id").to_numpy(), [None] * batch.num_rows
            for size, here, mine in _sized(batch):
                points, names, centres = sent.value.get(size, (np.empty((0, size)), np.empty(0), np.zeros((1, size))))
                away = np.array([cover.value.get((size, p), -np.inf) for p in range(len(centres))])
                if len(points) >= k and not _wide(mine, points):
                    for at in range(0, len(here), 256):
                        scores = mine[at : at + 256] @ points.T
                        scores[ids[here[at : at + 256], None] == names[None, :]] = -np.inf
                        own = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
                        floor[here[at : at + 256]] = np.maximum(floor[here[at : at + 256]], own)
                product, length = mine @ centres.T, np.linalg.norm(mine, axis=1)
                there = np.isfinite(away) | (away > 0)
                product[:, ~there] = -np.inf
                best = np.argmax(product, axis=1)
                with np.errstate(invalid="ignore"):
                    bound = product + (1 + SLACK) * length[:, None] * away + SLACK * length[:, None] * np.linalg.norm(centres, axis=1)
                # Lengths of 0 and infinite distances: such pairs are compared.
                open_ = there & ~(bound < floor[here][:, None])
                open_[np.arange(len(here)), best] = False
                for i, row in enumerate(here):
                    pivots[row] = ([best[i]] if there[best[i]] else []) if first else np.flatnonzero(open_[i])
            lists = pa.array([np.asarray(p, dtype=np.int32) for p in pivots], pa.list_(pa.int32()))
            columns = [*(batch.column(c) for c in ("id", "v", "size", "row")), pa.array(floor), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "size", "row", "floor", "pivots"])

    return step


def _searched(asked: DataFrame, near: DataFrame, covers: DataFrame, k: int, kind: str) -> DataFrame:
    """(row, query_id, vec_id, score): each query's k best rows of the pivots that it visits."""
    asked = written(asked, "product_visits")
    visits = asked.select("size", F.explode("pivots").alias("pivot")).groupBy("size", "pivot").agg(F.count("*").alias("queries"))
    plan = join_keyed(covers, written(visits, "product_loads"), ["size", "pivot"], "inner")
    plan = written(plan.select("size", "pivot", F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks"), F.ceil(F.col("queries") / BLOCK_QUERIES).alias("query_blocks")), "product_plan")
    along = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    mine = join_keyed(asked.withColumn("pivot", F.explode("pivots")), plan, ["size", "pivot"], "inner").select(
        "size", "pivot", F.pmod(F.xxhash64("row"), F.col("query_blocks")).alias("qb"), along("blocks").alias("pb"), "row", "id", "floor", "v",
    )
    theirs = join_keyed(near, plan, ["size", "pivot"], "inner").select(
        "size", "pivot", along("query_blocks").alias("qb"), F.pmod(F.xxhash64("id", "v"), F.col("blocks")).alias("pb"),
        F.lit(None).cast("bigint").alias("row"), "id", F.lit(None).cast("double").alias("floor"), "v",
    )

    def search(table: pa.Table) -> pa.Table:
        row = table.column("row")
        is_query = np.asarray(row.is_valid())
        empty = pa.table({n: pa.array([], t) for n, t in (("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()))})
        if is_query.all() or not is_query.any():
            return empty
        vectors, ids = _matrix(table.column("v")), table.column("id").to_numpy()
        floor = table.column("floor").fill_null(0).to_numpy()[is_query]
        best = Best(ids[is_query], k, floor)
        (_wide_search if _wide(vectors) else dual_search)(vectors[is_query], vectors[~is_query], ids[~is_query], best)
        rows = row.fill_null(0).to_numpy()[is_query]
        n = [len(x) for x in best.scores]
        scores = [int(s) for x in best.scores for s in x]
        return pa.table({
            "row": np.repeat(rows, n), "query_id": np.repeat(best.ids, n),
            "vec_id": np.concatenate(best.found).astype(np.int64), "score": pa.array(scores, pa.int64()),
        })

    found = mine.union(theirs).groupBy("size", "pivot", "qb", "pb").applyInArrow(search, "row bigint, query_id bigint, vec_id bigint, score bigint")
    return _ranked(found, k).drop("rank")
