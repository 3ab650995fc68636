"""Profiles and quantiles against plain ones, and the errors of the sketches."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import describe, fills, quantiles
from millrace.operators.describe import estimates, merged, sketches
from millrace.operators.quantiles import exact_quantiles


def plain_quantile(values, share):
    values = sorted(values)
    place = (len(values) - 1) * share
    a, b = values[math.floor(place)], values[math.ceil(place)]
    part = place - math.floor(place)
    return a if a == b else a * (1 - part) + b * part


def numbers(seed=0):
    rnd = random.Random(seed)
    rows = [("many", rnd.choice([rnd.gauss(0, 1), float(rnd.randrange(20)), 1e9 * rnd.random()])) for _ in range(6000)]
    rows += [("equal", 4.5)] * 300 + [("few", float(x)) for x in (9, 1, 4)] + [("one", -2.0), ("none", None), (None, 7.0), (None, 8.0), ("few", None), ("few", float("nan"))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, x double").repartition(5)


SHARES = (0.0, 0.25, 0.5, 0.9, 1.0)


@pytest.mark.parametrize("narrow", [False, True])
@pytest.mark.parametrize("miss", [False, True])
def test_quantiles_are_exact(spark, monkeypatch, narrow, miss):
    if narrow:
        monkeypatch.setattr(fills, "ORDERED_VALUES", 40)
    if miss:  # brackets that miss their ranks are noticed
        monkeypatch.setattr(quantiles, "MARGIN", -0.01)
    rows = numbers()
    df = frame(spark, rows)
    got = exact_quantiles(df, {"x": F.when(~F.isnan("x"), F.col("x")), "y": F.col("x") * 0 + 1}, ["g"], SHARES)
    got = {(r.g, r["column"], r.share): r.value for r in got.collect()}
    groups = {}
    for g, x in rows:
        if x is not None and not math.isnan(x):
            groups.setdefault(g, []).append(x)
    for g, xs in groups.items():
        for s in SHARES:
            assert math.isclose(got[g, "x", s], plain_quantile(xs, s), rel_tol=1e-12), (g, s)
    assert {k[0] for k in got if k[1] == "x"} == set(groups)


def test_quantiles_without_groups_and_rows(spark):
    df = frame(spark, [("a", float(x)) for x in range(101)])
    got = exact_quantiles(df, {"x": F.col("x")}).collect()
    assert sorted((r.share, r.value) for r in got) == [(0.25, 25.0), (0.5, 50.0), (0.75, 75.0)]
    assert exact_quantiles(df.limit(0), {"x": F.col("x")}).collect() == []
    assert exact_quantiles(df, {"x": F.lit(None).cast("double")}, ["g"]).collect() == []


def test_describe(spark):
    rows = [("a", 1.0, "u", 1), ("a", 2.0, "u", None), ("a", 3.0, None, 2), ("a", 100.0, "v", 2), ("a", float("nan"), "w", 2), ("b", None, None, None)]
    df = spark.createDataFrame(rows, "g string, x double, t string, k int")
    got = {(r.g, r["column"]): r for r in describe.describe(df, by=["g"]).collect()}
    x = got["a", "x"]
    assert (x.rows, x.nulls, x.distinct, x.least, x.most) == (5, 1, 4, 1.0, 100.0)
    assert (x.q1, x["median"], x.q3) == (1.75, 2.5, 27.25) and (x.low_fence, x.high_fence, x.outliers) == (-36.5, 65.5, 1)
    t = got["a", "t"]
    assert (t.nulls, t.distinct, t.least_text, t.most_text, t.top_value, t.top_times, t.q1, t.outliers) == (1, 3, "u", "w", "u", 2, None, None)
    assert (got["a", "k"].top_value, got["a", "k"].top_times, got["a", "k"].q1) == ("2", 3, 1.75)
    empty = got["b", "x"]
    assert (empty.rows, empty.nulls, empty.distinct, empty.least, empty.q1, empty.top_value) == (1, 1, 0, None, None, None)
    whole = {r["column"]: r for r in describe.describe(df, ["x", "t"]).collect()}
    assert (whole["x"].rows, whole["x"]["median"], whole["t"].top_value) == (6, 2.5, "u")
    assert [r.q1 for r in describe.describe(df, ["t"]).collect()] == [None]
    assert describe.describe(df.limit(0), by=["g"]).collect() == []


def test_sketches_of_batches_merge(spark):
    """Counts and extremes are exact; estimates are within the sketches' errors, however the rows were split."""
    n = 40_000
    df = spark.range(n, numPartitions=6).select(
        (F.col("id") % 5).alias("batch"), (F.sqrt(F.col("id").cast("double")) * 3).alias("x"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 9000).cast("string"))).alias("t"))
    parts = sketches(df, ["x", "t"], ["batch"])
    whole = {r["column"]: r for r in estimates(merged(parts)).collect()}
    direct = {r["column"]: r for r in estimates(sketches(df, ["x", "t"])).collect()}
    x, t = whole["x"], whole["t"]
    assert (x.rows, x.nulls, x.least, x.most) == (n, 0, 0.0, 3 * math.sqrt(n - 1)) == (direct["x"].rows, direct["x"].nulls, direct["x"].least, direct["x"].most)
    assert (t.rows, t.nulls, t.missing_percent, t.least_text) == (n, n // 4, 25.0, "v1")
    for found in (whole, direct):
        assert abs(found["x"].distinct / n - 1) < 0.05
        for share, value in ((0.25, found["x"].q1), (0.5, found["x"]["median"]), (0.75, found["x"].q3)):
            rank = (value / 3) ** 2 / n
            assert abs(rank - share) < 0.01
        assert found["t"].q1 is None
        item = found["t"].frequent[0]
        times = sum(1 for i in range(n) if i % 4 and (i % 3 == 0 or i % 9000 == 7))
        assert item.value == "v7" and abs(item.times - times) <= n / describe.TRACKED + times * 0.02


def test_nan_and_odd_names(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None)], "`x y` double, `t.u` string")
    got = {r["column"]: r for r in estimates(sketches(df)).collect()}
    assert (got["x y"].nulls, got["x y"].distinct, got["t.u"].nulls) == (1, 1, 1)
