"""Row, profile, fill and coercion operators."""

import random

import pytest
from conftest import column, rows
from pyspark.sql import functions as F

from millrace.operators import attach as attaching
from millrace.operators import coerce, fills, profile
from millrace.operators import rows as row_ops


def test_summary_rows_count_substrings(spark):
    frame = spark.createDataFrame(
        [("Subtotal", 5.0), ("Account", 5.0), ("AVERAGE count", 5.0), ("Account total", 5.0), (None, None)],
        "label string, amount double")
    assert column(row_ops.drop_summary_rows(frame), "label") == ["Account", None]
    assert rows(row_ops.summary_row_counts(frame)) == [(5, 3)]


def test_duplicates_treat_nulls_nans_and_zeros_as_equal(spark):
    frame = spark.createDataFrame(
        [(None, 0.0), (None, -0.0), ("a", float("nan")), ("a", float("nan")), ("a", 1.0)], "a string, b double")
    once = row_ops.drop_duplicate_rows(frame)
    assert once.count() == 3
    assert row_ops.drop_duplicate_rows(once).count() == 3


def thresholds(spark):
    data = [(i, 1.0 if i < 2 else None, 1.0 if i < 1 else None, 1.0 if i < 18 else None) for i in range(20)]
    return spark.createDataFrame(data, "job_id int, at90 double, at95 double, at10 double")


def test_sparse_is_strictly_more_than_ninety_percent(spark):
    decided = profile.sparse_columns(thresholds(spark), ["at90", "at95", "at10", "job_id"])
    found = {r["column"]: r["decision"] for r in decided.collect()}
    assert found == {"at90": "fill", "at95": "drop", "at10": "fill", "job_id": "keep"}
    assert profile.drop_sparse_columns(thresholds(spark)).columns == ["job_id", "at90", "at10"]


def test_alert_is_strictly_more_than_ten_percent(spark):
    assert rows(profile.missing_alerts(thresholds(spark)), "column") == [("at90", 18), ("at95", 19)]


def test_profile_of_no_rows_is_null(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert rows(profile.null_profile(empty, ["a", "b"]), "column") == [("a", 0, None), ("b", 0, None)]


def test_wide_profiles_are_a_union_of_narrow_ones(spark, monkeypatch):
    frame = spark.range(10).select(*[F.when(F.col("id") > i, i).alias(f"c{i}") for i in range(7)])
    whole = rows(profile.null_profile(frame, frame.columns), "column")
    monkeypatch.setattr(profile, "COLUMNS_PER_AGGREGATE", 2)
    assert rows(profile.null_profile(frame, frame.columns), "column") == whole


def test_median_and_mode(spark):
    frame = spark.createDataFrame(
        [(1, "b"), (2, "a"), (None, "b"), (4, "a"), (9, None)], "v int, t string")
    filled = fills.fill_missing(frame, ["v"], ["t"])
    assert sorted(column(filled, "v")) == [1.0, 2.0, 3.0, 4.0, 9.0]
    assert column(filled, "t") == ["b", "a", "b", "a", "a"]
    assert filled.dtypes == [("v", "double"), ("t", "string")]


def test_fills_are_per_group_and_null_groups_are_groups(spark):
    frame = spark.createDataFrame(
        [("x", 1.0, "p"), ("x", None, None), (None, 8.0, "q"), (None, None, None)],
        "g string, v double, t string")
    filled = fills.fill_missing(frame, ["v"], ["t"], ["g"])
    assert sorted(rows(filled), key=str) == sorted(
        [("x", 1.0, "p"), ("x", 1.0, "p"), (None, 8.0, "q"), (None, 8.0, "q")], key=str)


def groups(spark, seed, n=4000, distinct=None):
    """Two thirds of all rows in one group; values from few or many."""
    rng = random.Random(seed)
    pick = (lambda: rng.randint(0, distinct)) if distinct else (lambda: rng.gauss(0, 1e6))
    data = [("hot" if rng.random() < 0.67 else f"g{rng.randint(0, 5)}",
             None if rng.random() < 0.1 else float(pick()), float(pick())) for _ in range(n)]
    data += [("single", 5.0, 6.0), ("pair", 1.0, 2.0), ("pair", 4.0, 2.0), ("none", None, 1.0)]
    return spark.createDataFrame(data, "g string, a double, b double").repartition(4, "b")


@pytest.mark.parametrize("distinct", [None, 3, 200])
@pytest.mark.parametrize("ordered", [8, 1_000_000])
def test_bracketed_medians_are_exact(spark, monkeypatch, distinct, ordered):
    frame = groups(spark, 1, distinct=distinct)
    values = {"a": F.col("a"), "b": F.col("b")}
    want = rows(fills.exact_medians(frame, values, ["g"], 1), "g", "column")
    monkeypatch.setattr(fills, "ORDERED_VALUES", ordered)
    assert rows(fills.bracketed_medians(frame, values, ["g"], 4000), "g", "column") == want


def test_a_bracket_that_misses_is_redone(spark, monkeypatch):
    frame = groups(spark, 2, 600)
    values = {"a": F.col("a")}
    want = rows(fills.exact_medians(frame, values, ["g"], 1), "g")
    right = fills._brackets

    def wrong(*args):
        return right(*args).withColumn("_cut_0", F.expr("array(-2e9D, -1e9D)"))

    monkeypatch.setattr(fills, "_brackets", wrong)
    assert rows(fills.bracketed_medians(frame, values, ["g"], 600), "g") == want


@pytest.mark.parametrize("distinct", [None, 3])
@pytest.mark.parametrize("ordered", [8, 1_000_000])
def test_bracketed_medians_without_groups(spark, monkeypatch, distinct, ordered):
    frame = groups(spark, 4, distinct=distinct)
    values = {"a": F.col("a"), "b": F.col("b")}
    want = rows(fills.exact_medians(frame, values, (), 1), "column")
    monkeypatch.setattr(fills, "ORDERED_VALUES", ordered)
    assert rows(fills.bracketed_medians(frame, values, (), 4000), "column") == want
    right = fills._brackets
    monkeypatch.setattr(fills, "_brackets", lambda *args: right(*args).withColumn("_cut_0", F.expr("array(-2e9D, -1e9D)")))
    assert rows(fills.bracketed_medians(frame, values, (), 4000), "column") == want


def test_a_table_too_large_for_the_builtin_median_is_filled_without_groups(spark):
    n = fills.BUILTIN_MEDIAN_CELLS + 10
    frame = spark.range(n).select("id", F.when(F.col("id") >= 10, F.col("id") * 2.0).alias("v"), F.lit(None).cast("double").alias("none"))
    filled = fills.fill_missing(frame, ["v", "none"])
    assert filled.dtypes == [("id", "bigint"), ("v", "double"), ("none", "double")]
    # Of the values 20, 22, ... the two middle ones are n + 8 and n + 10.
    assert rows(filled.filter("id < 10").select("v").distinct()) == [(n + 9.0,)]
    assert filled.filter("id >= 10 AND v = id * 2 AND none IS NULL").count() == n - 10


def test_nan_has_no_part_in_the_median_of_a_large_table(spark):
    n = fills.BUILTIN_MEDIAN_CELLS + 10
    nan = F.lit(float("nan"))
    value = F.when(F.col("id") % 5 == 0, nan).when(F.col("id") % 5 == 1, None).otherwise(F.col("id") % 5)
    frame = spark.range(n).select("id", value.alias("d"), nan.alias("nothing"))
    assert rows(profile.null_profile(frame, ["d"])) == [("d", n * 2 // 5, 40.0)]
    filled = fills.fill_missing(frame, ["d", "nothing"])
    want = {2.0: n // 5, 3.0: n // 5 * 3, 4.0: n // 5}
    assert {r["d"]: r["count"] for r in filled.groupBy("d").count().collect()} == want
    assert filled.filter("nothing IS NOT NULL").isEmpty()


def test_attach_with_and_without_broadcast(spark):
    from millrace.session import written

    frame = groups(spark, 3, 500)
    table = written(frame.groupBy("g").agg(F.max("b").alias("top")), "tops")
    near = attaching.attach(frame, table, ["g"])
    far = attaching.attach(frame, table, ["g"], broadcast_bytes=0)
    assert sorted(rows(near), key=str) == sorted(rows(far), key=str)
    assert near.count() == frame.count()
    assert attaching.text_bytes(table) > 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [None, 0])
def test_attach_without_groups(spark, how, limit):
    from millrace.session import written

    frame = groups(spark, 3, 500)
    table = written(frame.agg(F.max("b").alias("top")), "top")
    every = attaching.attach(frame, table, [], how, broadcast_bytes=limit)
    assert every.columns == [*frame.columns, "top"]
    assert every.filter(F.col("top") == table.first()["top"]).count() == every.count() == frame.count()


def test_any_number_makes_a_column_numeric(spark):
    frame = spark.createDataFrame(
        [("ID", "x", "1"), ("84043", "y", "2"), ("UT", None, "3")], "a string, b string, c string")
    out = coerce.coerce_numbers(frame, ["a", "b", "c"])
    assert out.dtypes == [("a", "double"), ("b", "string"), ("c", "bigint")]
    assert column(out, "a") == [None, 84043.0, None]
    kept = coerce.coerce_numbers(frame, ["a", "b", "c"], min_share=0.5)
    assert kept.dtypes[0] == ("a", "string")


def test_text_named_like_a_date_becomes_null_dates(spark):
    frame = spark.createDataFrame([(1, "bob"), (2, "al")], "i int, updated_by string")
    out = coerce.coerce_dates(frame, ["i"])
    assert out.dtypes[1] == ("updated_by", "timestamp_ntz")
    assert column(out, "updated_by") == [None, None]


def test_nan_is_missing_in_every_operator(spark):
    frame = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, float("nan")), (4, None)], "i int, v double")
    assert rows(profile.null_profile(frame, ["v"])) == [("v", 2, 50.0)]
    assert rows(fills.fill_missing(frame, medians=["v"]), "i") == [(1, 1.0), (2, 3.0), (3, 2.0), (4, 2.0)]
    assert rows(profile.missing_alerts(frame)) == [("v", 2)]
    assert profile.drop_sparse_columns(frame, 40).columns == ["i"]
