"""Schema drift: types of snapshots, every kind of change, versions, renames."""

import pytest
from pyspark.sql import functions as F

from millrace.sources import drift as D
from millrace.sources.drift import drift, load_snapshot, save_snapshot, snapshot, versions


def changes(found, *by):
    return {(*[r[b] for b in by], r["column"]): (r.change, r.old_column, r.old_type, r.new_type) for r in found.collect()}


def test_types_of_a_snapshot(spark):
    rows = [("1", "1.5", "true", "x", None, "NA", 1, 2.5, True, "7"), ("2", "3", "False", "3", None, "", 2, float("nan"), None, " 8 ")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g int, h double, i boolean, j string")
    df = df.withColumn("k", F.current_date()).withColumn("l", F.current_timestamp()).withColumn("m", F.lit("1").cast("decimal(5,2)")).withColumn("n", F.array("a"))
    got = {r["column"]: r for r in snapshot(df).collect()}
    assert {c: r["type"] for c, r in got.items()} == dict(
        a="whole", b="number", c="boolean", d="text", e="empty", f="empty", g="whole", h="number", i="boolean", j="whole",
        k="date", l="timestamp", m="number", n="text")
    assert [got[c].position for c in "abcdefghijklmn"] == list(range(14)) and (got["h"].rows, got["h"].nulls, got["f"].nulls) == (2, 1, 2)


def test_lattice_is_an_order():
    for low, above in D.ABOVE.items():
        assert low not in above
        for high in above:
            assert set(D.ABOVE[high]) <= set(above)


def test_every_change_in_each_group(spark):
    old = spark.createDataFrame([(g, i, str(i), f"t{i}", i * 2, f"n{i}") for g in ("a", "b", None) for i in range(200)], "g string, id int, code string, name string, twice int, gone string")
    new = spark.createDataFrame(
        [(g, i, str(i) if g == "a" else f"c{i}", i, f"t{i}", bool(i % 2)) for g in ("a", "b", None) for i in range(10, 210)] + [("c", 1, "1", 1, "t", True)],
        "g string, id int, code string, label int, title string, flag boolean")
    got = changes(drift(snapshot(old, ["g"]), snapshot(new, ["g"]), ["g"]), "g")
    for g in ("a", "b", None):
        code = ("kept", "code", "whole", "whole") if g == "a" else ("widened", "code", "whole", "text")
        assert {c: x for (h, c), x in got.items() if h == g} == {
            "id": ("kept", "id", "whole", "whole"), "code": code, "title": ("renamed", "name", "text", "text"),
            "label": ("added", None, None, "whole"), "twice": ("removed", "twice", "whole", None),
            "gone": ("removed", "gone", "text", None), "flag": ("added", None, None, "boolean"),
        }
    assert {x[0] for (g, _), x in got.items() if g == "c"} == {"added"}


def test_renames_are_one_to_one(spark):
    rows = [(i, i, i + 1000) for i in range(300)]
    old = spark.createDataFrame(rows, "a int, b int, c int")
    new = spark.createDataFrame([(x, z, y) for x, y, z in rows], "p int, q int, r int")
    got = changes(drift(snapshot(old), snapshot(new)))
    assert {c: x[:2] for (c,), x in got.items()} == {"p": ("renamed", "a"), "q": ("renamed", "c"), "r": ("renamed", "b")} or {
        c: x[:2] for (c,), x in got.items()} == {"p": ("renamed", "a"), "q": ("renamed", "c"), "r": ("added", None), "b": ("removed", "b")}
    far = changes(drift(snapshot(old.select("a")), snapshot(old.select((F.col("a") + 150).alias("z")))))
    assert {x[0] for x in far.values()} == {"added", "removed"}
    near = changes(drift(snapshot(old.select("a")), snapshot(old.select((F.col("a") + 15).cast("double").alias("z")))))
    assert {x[0] for x in near.values()} <= {"renamed", "added", "removed"}


def test_narrowed_changed_and_empty(spark):
    old = spark.createDataFrame([("1.5", "x", "true", None)], "a string, b string, c string, d string")
    new = spark.createDataFrame([("2", "7", "3", "4")], "a string, b string, c string, d string")
    got = changes(drift(snapshot(old), snapshot(new)))
    assert [got[c,][0] for c in "abcd"] == ["narrowed", "narrowed", "changed", "widened"]
    none = snapshot(old.limit(0), columns=["a"])
    assert changes(drift(none, none)) == {("a",): ("kept", "a", "empty", "empty")}


def test_versions(spark, tmp_path):
    folder = str(tmp_path / "snapshots")
    assert versions(spark, folder) == []
    with pytest.raises(ValueError, match="at all"):
        load_snapshot(spark, folder)
    for n in range(3):
        df = spark.createDataFrame([(n, "x")], "a int, b string").drop("b" if n == 1 else "zz")
        assert save_snapshot(snapshot(df), folder) == n
    (tmp_path / "snapshots" / "version=2" / "_SUCCESS").unlink()
    assert versions(spark, folder) == [0, 1]
    assert load_snapshot(spark, folder).count() == 1 and load_snapshot(spark, folder, 0).count() == 2
    with pytest.raises(ValueError, match="version 2"):
        load_snapshot(spark, folder, 2)
    assert save_snapshot(snapshot(df), folder) == 2 and versions(spark, folder) == [0, 1, 2]
