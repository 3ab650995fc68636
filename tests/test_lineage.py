"""Lineage of cleaned and merged rows, against the files themselves."""

import pytest
from conftest import rows

from millrace import build_master, clean_files
from millrace.plans.clean import CleanOptions
from millrace.plans.lineage import clean_edges, contributing_files, lineage, merge_edges, row_id, with_row_ids
from millrace.plans.rules import RULES

FILES = {
    "a.csv": "Link,name,size\nx/1,ann,5\nx/1,ann,5\nx/2,bob,\nx/2,bob,5\nnone,cy,7\n",
    "b.csv": "Link,town\nx/1,rome\nx/1,oslo\nx/3,bonn\nnone,kiel\n",
    "c.csv": "Link,name\nx/1,zed\nx/4,yak\nx/4,yak\n",
}


def places(batch):
    """The order of each file's rows, from 0."""
    found = rows(clean_edges(batch).select("source_file", "row"), "source_file", "row")
    seen = {}
    return {(f, r): seen.setdefault(f, []).append(r) or len(seen[f]) - 1 for f, r in found}


def test_every_input_row_has_one_cleaned_row(spark, folder):
    batch = clean_files(spark, folder(FILES))
    at = places(batch)
    assert sorted(at.values()) == sorted([*range(5), *range(4), *range(3)])
    ids = with_row_ids(batch.data)
    assert ids.count() == ids.select("row_id").distinct().count()
    edges = rows(ids.join(clean_edges(batch).drop("source_file"), "row_id").select("source_file", "job_id", "name", "town", "row"), "source_file", "row")
    assert [(f, k, n, t, at[f, r]) for f, k, n, t, r in edges if f == "a.csv"] == [
        ("a.csv", 1, "ann", None, 0), ("a.csv", 1, "ann", None, 1), ("a.csv", 2, "bob", None, 2), ("a.csv", 2, "bob", None, 3), ("a.csv", None, "cy", None, 4)]


@pytest.mark.parametrize("merge, want", [
    ("outer", {
        (1, "ann", "rome"): {("a.csv", 0), ("a.csv", 1), ("b.csv", 0), ("c.csv", 0)}, (1, "ann", "oslo"): {("a.csv", 0), ("a.csv", 1), ("b.csv", 1), ("c.csv", 0)},
        (2, "bob", None): {("a.csv", 2), ("a.csv", 3)}, (None, "cy", "kiel"): {("a.csv", 4), ("b.csv", 3)},
        (3, None, "bonn"): {("b.csv", 2)}, (4, None, None): {("c.csv", 1), ("c.csv", 2)},
    }),
    ("inner", {
        (1, "ann", "rome"): {("a.csv", 0), ("a.csv", 1), ("b.csv", 0), ("c.csv", 0)}, (1, "ann", "oslo"): {("a.csv", 0), ("a.csv", 1), ("b.csv", 1), ("c.csv", 0)},
    }),
])
def test_master_rows_join_back_to_their_input(spark, folder, merge, want):
    batch = clean_files(spark, folder(FILES))
    master, at = build_master(batch, merge), places(batch)
    found = with_row_ids(master.data, "master_id").distinct().join(lineage(batch, master, merge).withColumnRenamed("source_file", "file"), "master_id", "left")
    got = {}
    for r in found.collect():
        got.setdefault((r.job_id, r.name, r.town), set()).add((r.file, at[r.file, r.row]))
    assert got == want
    files = {(r.master_id, r.source_file): r.rows for r in contributing_files(batch, master, merge).collect()}
    assert len(files) == sum(len({f for f, _ in x}) for x in want.values()) and sum(files.values()) == sum(map(len, want.values()))


def test_stacked_and_single_files(spark, folder):
    batch = clean_files(spark, folder(FILES))
    master = build_master(batch, "concat")
    assert all(m == r for m, r in rows(merge_edges(batch, master, "concat"))) and lineage(batch, master, "concat").count() == 12
    one = clean_files(spark, folder({"a.csv": FILES["a.csv"]}, "one"))
    assert lineage(one, build_master(one)).count() == 5


def test_lineage_under_rules(spark, folder):
    rules = spark.createDataFrame([("c%", "rename", "name", "town"), ("a%", "drop", "size", None)], RULES)
    batch = clean_files(spark, folder(FILES), options=CleanOptions(rules=rules))
    found = with_row_ids(batch.data).join(clean_edges(batch).select("row_id", "row"), "row_id")
    assert found.count() == 12 and "size" not in batch.data.columns


def test_row_ids_tell_nulls_apart(spark):
    frame = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None), ("", None)], "x string, `y.z` string")
    assert frame.select(row_id(frame.columns)).distinct().count() == 5
    assert frame.select(row_id(["y.z", "x"])).first() == frame.select(row_id(["x", "y.z"])).first()
