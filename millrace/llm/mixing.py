"""Mixing sources to target weights, by hash-threshold histograms.

Each source has a weight and a size, the words of its documents. Its target is its share of
the mix's size, stopped at `cap` times its own size; what that leaves over is shared again
by weight until no target is above its stop. A target of 2.4 times a source's size takes
every document twice and a part of them, of 0.4 times the size, once more.

That part is the documents whose hash is below the source's threshold, so a smaller budget
always takes a part of what a larger one takes. The threshold is found without sorting: the
sizes are summed by source and leading hash bits, the sums along the buckets show in which
bucket the budget ends, and only rows of that bucket are summed again by the next bits. Each
level reads a written table of numbers and brings one row per source to the driver; the
sources themselves are a configuration and bounded by it.

Documents with the same hash (equal id and size) are told apart by their row in the written
table; such rows are alike, so reruns agree. A document at the threshold is taken if the
budget reaches its middle. A null source is a source, the last by order; null texts have no
words; documents without words are never taken. Null ids are one id. Empty tables give no
rows. Other columns are carried along; helper names start with `_mix`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import written

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash, and of one level of its histogram.
HASH_BITS, LEVEL_BITS = 60, 12


def hash_key(id: Column, size: Column, seed: str = "mix") -> Column:
    """The first 60 bits of an md5, so that any SQL engine finds the same order."""
    text = F.concat(F.lit(f"{seed}/"), F.coalesce(id.cast("string"), F.lit("")), F.lit("/"), size.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: dict[str | None, int], weights: Sequence[float], cap: float = 3.0, budget: float | None = None) -> dict[str | None, float]:
    """Each source's target: `weights` repeat along the sources by code point, null last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = float(sum(sizes.values())) if budget is None else budget
    queue = sorted(names, key=lambda s: (cap * sizes[s] / weight[s], s is None, (s or "").encode()))
    stopped, rest = 0.0, sum(weight.values())
    level = 0.0
    for s in queue:
        level = (total - stopped) / rest
        if level * weight[s] <= cap * sizes[s]:
            break
        stopped += cap * sizes[s]
        rest -= weight[s]
        level = math.inf
    return {s: min(cap * sizes[s], level * weight[s]) for s in names}


def _thresholds(rows: DataFrame, parts: dict[str | None, float]) -> dict[str | None, tuple[int, int]]:
    """Per source (key, tie): a row is in its source's part if (_mix_key, _mix_tie) is below.

    Levels go on until a bucket holds one row, or all bits of key and tie are used.
    """
    widths = [LEVEL_BITS] * (HASH_BITS // LEVEL_BITS)
    open_ = {s: [0, 0, part] for s, part in parts.items()}  # key prefix, tie prefix, what is left
    done: dict[str | None, tuple[int, int]] = {}
    spark = rows.sparkSession
    for column in ("_mix_key", "_mix_tie"):
        used = 0
        for width in widths:
            if not open_:
                return done
            used += width
            shift = HASH_BITS - used
            state = spark.createDataFrame(
                [(s, k, t, float(left)) for s, (k, t, left) in open_.items()],
                f"s {dict(rows.dtypes)['_mix_source']}, k bigint, t bigint, `left` double",
            )
            on = rows["_mix_source"].eqNullSafe(state["s"])
            if column == "_mix_key":
                on = on & (F.shiftright(rows["_mix_key"], shift + width) == state["k"])
            else:
                on = on & (rows["_mix_key"] == state["k"]) & (F.shiftright(rows["_mix_tie"], shift + width) == state["t"])
            inside = rows.join(F.broadcast(state), on).withColumn("_b", F.shiftright(column, shift))
            sums = inside.groupBy("s", "left", "k", "_b").agg(F.sum("_mix_size").alias("n"), F.count("*").alias("rows"))
            along = Window.partitionBy("s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
            sums = sums.withColumn("upto", F.sum("n").over(along))
            # Of each source the first bucket that the budget does not fill, if there is one.
            at = sums.where("upto > `left`").groupBy("s").agg(F.min(F.struct("_b", "n", "rows", "upto")).alias("x"))
            found = {r["s"]: r["x"] for r in at.collect()}
            for s, (key, tie, left) in list(open_.items()):
                x = found.get(s)
                if x is None:  # the budget takes all there is
                    prefix = key if column == "_mix_key" else tie
                    past = (prefix + 1) << (HASH_BITS - used + width)
                    done[s] = (past, 0) if column == "_mix_key" else (key, past)
                    del open_[s]
                    continue
                left -= x["upto"] - x["n"]
                last = column == "_mix_tie" and used == HASH_BITS
                if x["rows"] == 1 or last:
                    edge = (x["_b"] + (1 if 2 * left > x["n"] else 0)) << shift
                    done[s] = (edge, 0) if column == "_mix_key" else (key, edge)
                    del open_[s]
                else:
                    open_[s] = [x["_b"], 0, left] if column == "_mix_key" else [key, x["_b"], left]
    return done


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, budget: float | None = None, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or only its columns `keep`) with `_mix_size`, `_mix_source_size`, `_mix_target`, `_mix_times`.

    `_mix_times`: how often the mix takes the document.
    """
    kept = docs.columns if keep is None else keep
    size = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{id}`").alias("_mix_id"), F.col(f"`{source}`").alias("_mix_source"), size.alias("_mix_size"))
    rows = rows.withColumn("_mix_key", hash_key(F.col("_mix_id"), F.col("_mix_size")))
    tie = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - HASH_BITS)
    rows = written(rows.drop("_mix_id").withColumn("_mix_tie", tie), "mix_rows")
    numbers = rows.select("_mix_source", "_mix_size", "_mix_key", "_mix_tie")
    sizes = {r[0]: int(r[1]) for r in numbers.groupBy("_mix_source").agg(F.sum("_mix_size")).collect()}
    goals = targets(sizes, weights, cap, budget)
    whole = {s: int(min(cap, goals[s] // sizes[s])) if sizes[s] else 0 for s in sizes}
    parts = {s: goals[s] - whole[s] * sizes[s] for s in sizes if sizes[s] and goals[s] > whole[s] * sizes[s]}
    edges = _thresholds(numbers.where("_mix_size > 0"), parts) if parts else {}
    table = docs.sparkSession.createDataFrame(
        [(s, sizes[s], float(goals[s]), whole[s], *edges.get(s, (0, 0))) for s in sizes],
        f"_mix_name {dict(rows.dtypes)['_mix_source']}, _mix_source_size bigint, _mix_target double, _mix_whole int, _mix_edge bigint, _mix_edge_tie bigint",
    )
    below = (F.col("_mix_key") < F.col("_mix_edge")) | ((F.col("_mix_key") == F.col("_mix_edge")) & (F.col("_mix_tie") < F.col("_mix_edge_tie")))
    times = F.when(F.col("_mix_size") > 0, F.col("_mix_whole") + below.cast("int")).otherwise(0)
    joined = rows.join(F.broadcast(table), rows["_mix_source"].eqNullSafe(table["_mix_name"]))
    return joined.select(*[F.col(f"`{c}`") for c in kept], "_mix_size", "_mix_source_size", "_mix_target", times.alias("_mix_times"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with `docs`' columns."""
    taken = mix(docs, **options)
    copies = taken.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))).where("_mix_times > 0")
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])
