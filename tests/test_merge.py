"""Merges against the documented cases and against a plain fold of pandas merges."""

import random

import pandas as pd
import pytest
from conftest import rows

from pyspark.sql import functions as F

from millrace.operators import merge

LEFT = [(1, "l1", "left"), (None, "ln", "left"), (3, "l3", "left")]
RIGHT = [(1, "r1", 10, "right"), (None, "rn1", 20, "right"), (None, "rn2", 30, "right"), (4, "r4", 40, "right")]


def pair(spark):
    return [
        spark.createDataFrame(LEFT, "job_id bigint, a string, source_file string"),
        spark.createDataFrame(RIGHT, "job_id bigint, a string, z int, source_file string"),
    ]


def text_sorted(data):
    return sorted(data, key=str)


def test_outer_first_file_wins_and_nulls_match(spark):
    out = merge.merge_frames(pair(spark), "outer")
    assert out.columns == ["job_id", "a", "source_file", "z"]
    assert text_sorted(rows(out)) == text_sorted([
        (1, "l1", "left", 10), (None, "ln", "left", 20), (None, "ln", "left", 30),
        (3, "l3", "left", None), (4, None, None, 40)])
    assert merge.null_key_pairs(*pair(spark)) == 2


def test_inner(spark):
    out = merge.merge_frames(pair(spark), "inner")
    assert text_sorted(rows(out)) == text_sorted([
        (1, "l1", "left", 10), (None, "ln", "left", 20), (None, "ln", "left", 30)])


def test_columns_named_dup_are_dropped_by_any_merge(spark):
    left = spark.createDataFrame([(1, 2)], "job_id bigint, x_dup int")
    right = spark.createDataFrame([(1, 3, 4)], "job_id bigint, y int, z_dup int")
    assert merge.merge_frames([left, right]).columns == ["job_id", "y"]
    assert merge.merge_frames([left]).columns == ["job_id", "x_dup"]


def random_files(spark, seed, repeat):
    rng = random.Random(seed)
    shapes = [["job_id", "a"], ["b", "job_id", "a"], ["job_id", "a"], ["job_id", "c"], ["job_id", "b"]]
    frames = []
    for f, columns in enumerate(shapes):
        keys = [rng.choice([*range(6), None]) for _ in range(rng.randint(1, 9))]
        keys = keys if repeat else list(dict.fromkeys(keys))
        data = [tuple(k if c == "job_id" else f"{f}{c}{i}" for c in columns) for i, k in enumerate(keys)]
        schema = ", ".join(f"{c} {'bigint' if c == 'job_id' else 'string'}" for c in columns)
        frames.append((pd.DataFrame(data, columns=columns).astype(object), spark.createDataFrame(data, schema)))
    return frames


def pandas_fold(frames, how):
    """The oracle: merge with suffixes and drop the right-hand doubles, one file at a time."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.merge(frame, on="job_id", how=how, suffixes=("", "#right"))
        whole = whole[[c for c in whole.columns if not c.endswith("#right")]]
    whole = whole.astype(object).where(whole.notna(), None)
    return list(whole.columns), text_sorted(
        tuple(int(v) if isinstance(v, float) else v for v in r) for r in whole.itertuples(index=False))


@pytest.mark.parametrize("how", ["outer", "inner"])
@pytest.mark.parametrize("repeat", [True, False])
@pytest.mark.parametrize("hot", [True, False])
def test_fold_equals_file_by_file(spark, how, repeat, hot):
    skew = merge.Skew(task_rows=2) if hot else merge.Skew()
    for seed in range(2):
        both = random_files(spark, seed, repeat)
        columns, want = pandas_fold([p for p, _ in both], how)
        out = merge.merge_frames([s for _, s in both], how, skew=skew)
        assert out.columns == columns
        assert text_sorted(rows(out)) == want


def test_one_aggregation_equals_the_fold(spark):
    both = random_files(spark, 7, False)
    frames = [both[0][1], both[1][1], both[3][1]]
    for how in ("outer", "inner"):
        _, want = pandas_fold([both[0][0], both[1][0], both[3][0]], how)
        assert text_sorted(rows(merge.merge_unique(frames, how))) == want


def test_large_repeats_are_cut_to_pieces(spark, monkeypatch):
    monkeypatch.setattr(merge, "REPEAT_ROWS", 2)
    left = spark.createDataFrame([(1, "a"), (2, "b")], "job_id bigint, x string")
    right = spark.createDataFrame([(1, "q")] * 5 + [(3, "q")] * 3, "job_id bigint, x string")
    out = merge.merge_frames([left, right])
    assert text_sorted(rows(out)) == text_sorted([(1, "a")] * 5 + [(2, "b")] + [(3, None)] * 3)


def test_no_cell_of_a_hot_key_is_above_the_budget(spark):
    sides = {1: (900, 1), 2: (1, 700), 3: (300, 200), 4: (40, 4000), 5: (500, 0), 6: (0, 450), 7: (3, 4), None: (60, 60)}
    left = spark.createDataFrame([(k, i) for k, (n, _) in sides.items() for i in range(n)], "job_id bigint, v int")
    right = spark.createDataFrame([(k, i) for k, (_, n) in sides.items() for i in range(n)], "job_id bigint, w int")
    found = merge.count_keys([left, right], skew=merge.Skew(task_rows=100))
    assert found.most_per_key == 4000
    grids = {r.job_id: r for r in found.hot[0].collect()}
    assert set(grids) == {1, 2, 3, 4, 5, 6, None}
    for key, grid in grids.items():
        n, m = sides[key]
        assert -(-n // grid._rows) * -(-m // grid._columns) <= 4 * 100
        assert grid._rows <= max(n, 1) and grid._columns <= max(m, 1) and grid._both == (n > 0 and m > 0)
    for how in ("outer", "inner"):
        got = merge.merge_frames([left, right], how, skew=merge.Skew(task_rows=100)).groupBy("job_id").count().collect()
        want = {k: (n * m if n and m else (n + m) * (how == "outer")) for k, (n, m) in sides.items()}
        assert {r[0]: r[1] for r in got} == {k: n for k, n in want.items() if n}


def test_hot_keys_are_counted_against_rows_made(spark):
    many = spark.range(3000).select(F.lit(7).alias("job_id"), F.col("id").alias("v"))
    other = spark.range(3000).select(F.lit(7).alias("job_id"), F.col("id").alias("w"))
    found = merge.count_keys([many, other])
    grid = found.hot[0].first()
    assert grid._rows * grid._columns >= 9 and grid._both
    assert merge.count_keys([many, other.limit(10)]).hot == [None]


@pytest.mark.parametrize("key", [7, None])
def test_copies_of_hot_rows_grow_as_the_rows_read(spark, key):
    def side(n, name):
        hot = spark.range(n).select(F.lit(key).cast("bigint").alias("job_id"), F.col("id").alias(name))
        return hot.union(spark.range(100, 120).select("id", F.col("id") + n))

    copies = []
    for n in (400, 800, 1600):
        found = merge.count_keys([side(n, "v"), side(n, "w")], skew=merge.Skew(task_rows=1))
        grid = found.hot[0].filter(F.col("job_id").eqNullSafe(F.lit(key))).first()
        assert 900 <= grid._rows * grid._columns <= 2 * merge.CELLS
        copies.append(n * grid._columns + n * grid._rows)
    assert copies[2] <= 2.2 * copies[1] <= 2.2 * 2.2 * copies[0]
    for how in ("outer", "inner"):
        out = merge.merge_frames([side(1600, "v"), side(1500, "w")], how, skew=merge.Skew(task_rows=1))
        hot = out.filter(F.col("job_id").eqNullSafe(F.lit(key)))
        pair = F.col("v") * 1500 + F.col("w")
        assert hot.agg(F.count(pair), F.countDistinct(pair), F.max(pair)).first()[:] == (2_400_000, 2_400_000, 2_399_999)
        assert out.count() == 2_400_020


def test_more_tasks_get_more_cells_of_a_hot_key(spark):
    side = spark.range(1000).select(F.lit(7).alias("job_id"), F.col("id").alias("v"))
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        grid = merge.count_keys([side, side], skew=merge.Skew(task_rows=1)).hot[0].first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert grid._rows * grid._columns >= 1000 * merge.CELLS_PER_TASK


def test_no_cell_has_too_many_rows_of_a_side(spark, monkeypatch):
    monkeypatch.setattr(merge, "SIDE_ROWS", 100)
    sides = {1: (1000, 2), 2: (600, 600), 3: (0, 250), 4: (300, 1)}
    left = spark.createDataFrame([(k, i) for k, (n, _) in sides.items() for i in range(n)], "job_id bigint, v int")
    right = spark.createDataFrame([(k, i) for k, (_, n) in sides.items() for i in range(n)], "job_id bigint, w int")
    skew = merge.Skew(task_rows=200)
    grids = {r.job_id: r for r in merge.count_keys([left, right], skew=skew).hot[0].collect()}
    assert set(grids) == set(sides)
    for key, (n, m) in sides.items():
        assert -(-n // grids[key]._rows) <= 100 and -(-m // grids[key]._columns) <= 100
    got = merge.merge_frames([left, right], skew=skew).groupBy("job_id").agg(F.count(F.lit(1)), F.countDistinct("v"), F.countDistinct("w"))
    assert {r[0]: r[1:] for r in got.collect()} == {1: (2000, 1000, 2), 2: (360000, 600, 600), 3: (250, 0, 250), 4: (300, 300, 1)}


def test_rows_of_a_hot_key_are_given_out_one_by_one(spark):
    fused = "spark.sql.codegen.join.fullOuterSortMergeJoin.enabled"
    side = spark.range(300).select(F.lit(7).alias("job_id"), F.col("id").alias("v"))
    spark.conf.unset(fused)
    try:
        merge.merge_frames([side, side], "inner", skew=merge.Skew(task_rows=1))
        merge.merge_frames([side, side])
        assert spark.conf.get(fused, None) is None
        merge.merge_frames([side, side], skew=merge.Skew(task_rows=1))
        assert spark.conf.get(fused) == "false"
        spark.conf.set(fused, "true")
        merge.merge_frames([side, side], skew=merge.Skew(task_rows=1))
        assert spark.conf.get(fused) == "true"
    finally:
        spark.conf.unset(fused)


def test_stack_aligns_types(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([(2, 1.5)], "b bigint, c double")
    out = merge.stack_frames([one, two])
    assert out.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert rows(out) == [(1, "x", None), (None, "2", 1.5)]
    assert merge.aligned_type(["int", "double"]) == "double"
    assert merge.aligned_type(["timestamp_ntz", "string"]) == "string"


def test_null_keys_can_be_kept_apart(spark):
    frames = pair(spark)
    out = merge.merge_frames(frames, "outer", null_keys="keep")
    assert text_sorted(rows(out)) == text_sorted([
        (1, "l1", "left", 10), (None, "ln", "left", None), (3, "l3", "left", None), (4, None, None, 40),
        (None, None, None, 20), (None, None, None, 30)])
    assert rows(merge.merge_frames(frames, "inner", null_keys="keep")) == [(1, "l1", "left", 10)]


def test_an_exploding_merge_is_refused_if_asked_to(spark):
    many = spark.range(8).select(F.lit(None).cast("bigint").alias("job_id"), F.col("id").alias("x"))
    with pytest.raises(ValueError, match="would make 64 rows, 64 of them from null keys"):
        merge.merge_frames([many, many], max_result_rows=10)
    assert merge.merge_frames([many, many]).count() == 64
    assert merge.merge_frames([many, many], null_keys="keep", max_result_rows=16).count() == 16
