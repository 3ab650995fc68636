"""Row lineage: which input rows a cleaned row, and a row of the master dataset, come from.

Nothing is carried along with the data. A cleaned row is known by a hash of its columns, which
is unique once duplicates are dropped, so that the edges to the input rows (many to one) come
from the rows before that step. A master row is made of one row of every file that holds its
key, and has the values of the columns that a file owns: its edges (one to many) come from one
join per owning file, on the key and the file's columns, and one join for all files that own
none, on the key. So there are never more joins than columns. Rows of a file that are equal in
the key and all that the file owns made master rows that are equal too: each has edges to all.

Edges are tables of two ids, written by whoever wants to keep them; they are computed when read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import KEY, SOURCE
from millrace.operators.attach import same
from millrace.plans.clean import Batch
from millrace.plans.master import Master, owned_columns


def row_id(columns: Sequence[str]) -> Column:
    """128 bits of the columns' values, as text; nulls and their places count."""
    cells = [F.col(f"`{c}`") for c in sorted(columns)]
    places = [c.isNull() for c in cells]
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), *places, *cells)), 16, "0") for seed in (1, 2)]
    return F.concat(*halves)


def with_row_ids(data: DataFrame, name: str = "row_id") -> DataFrame:
    return data.withColumn(name, row_id([c for c in data.columns if c != name]))


def clean_edges(batch: Batch) -> DataFrame:
    """(row_id, source_file, row): from every cleaned row to the input rows that it stands for."""
    columns = [c for c in batch.origins.columns if c != "_row"]
    return batch.origins.select(row_id(columns).alias("row_id"), SOURCE, F.col("_row").alias("row"))


def merge_edges(batch: Batch, master: Master, merge: str = "outer") -> DataFrame:
    """(master_id, row_id): from every master row to the cleaned rows that it was made of.

    `master` was built from `batch` by the same `merge`, with null keys matching each other.
    """
    present = batch.decisions.filter("rows > 0")
    n, first = present.agg(F.count_distinct("_source"), F.min("_source")).first()
    rows = with_row_ids(master.data, "master_id")
    if n == 1 or merge == "concat":
        return rows.select("master_id", row_id(batch.data.columns).alias("row_id"))
    owned = owned_columns(batch, first)
    cleaned = with_row_ids(batch.data)
    source = F.col(f"_f_{SOURCE}")
    own = cleaned.toDF(*[f"_f_{c}" if c != "row_id" else c for c in cleaned.columns])
    rows = rows.distinct()
    parts = []
    for file, columns in owned.items():
        keys = [KEY, *columns]
        side = own.filter(source == file)
        parts.append(rows.join(side, same(rows, side, keys, [f"_f_{k}" for k in keys])).select("master_id", "row_id"))
    side = own.filter(~source.isin(list(owned)))
    parts.append(rows.join(side, same(rows, side, [KEY], [f"_f_{KEY}"])).select("master_id", "row_id"))
    return reduce(DataFrame.unionByName, parts)


def lineage(batch: Batch, master: Master, merge: str = "outer") -> DataFrame:
    """(master_id, source_file, row): from every master row to its input rows."""
    return merge_edges(batch, master, merge).join(clean_edges(batch), "row_id").select("master_id", SOURCE, "row")


def contributing_files(batch: Batch, master: Master, merge: str = "outer") -> DataFrame:
    """(master_id, source_file, rows): the files of every master row, and how many input rows of each."""
    return lineage(batch, master, merge).groupBy("master_id", SOURCE).agg(F.count_distinct("row").alias("rows"))
