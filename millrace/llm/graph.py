"""Connected components of a link table, with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable.

    Each round hooks every node to its smallest neighbour, follows the pointers to their
    ends, and replaces links by links between those ends; the number of nodes at least
    halves per round. Tables are written between steps, so lineage is cut and both sides of
    every join are plain shuffles whose hot keys adaptive execution can split. Links with a
    null end and links from a node to itself say nothing; an empty table gives no rows.
    """
    links = written(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("root")).where("false")
    first = True
    while not links.isEmpty():
        ends = links.union(links.select("b", "a"))
        hooks = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        hooks = written(hooks.select("node", F.least("node", "m").alias("up")), "hooks")
        moved = True
        while moved:
            over = hooks.select(F.col("node").alias("up"), F.col("up").alias("upper"))
            nearer = hooks.join(over, "up").select("node", F.col("upper").alias("up"), (F.col("up") != F.col("upper")).alias("moved"))
            nearer = written(nearer, "hooks")
            moved = not nearer.where("moved").isEmpty()
            hooks = nearer.drop("moved")
        if first:
            roots, first = hooks.select("node", F.col("up").alias("root")), False
        else:
            over = hooks.select(F.col("node").alias("root"), "up")
            roots = written(roots.join(over, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        left, right = (hooks.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up")) for end in "ab")
        links = links.join(left, "a").join(right, "b").where("a_up <> b_up")
        links = written(links.select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(), "links")
    return roots


def forest(count: int, left, right):
    """Smallest linked index for each of `count` items, from links between indexes (numpy, in a task)."""
    import numpy as np

    label = np.arange(count)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (before == label).all():
            break
        open_ = label[left] != label[right]
        left, right = left[open_], right[open_]
    return label
