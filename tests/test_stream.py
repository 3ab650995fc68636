"""Streams of files cleaned by content: touched, moved, repeated files, lost runs."""

import os

import pytest
from conftest import rows

from millrace.streaming import incremental
from millrace.streaming.incremental import clean_stream, content


def cleaned(spark, output):
    return rows(spark.read.option("mergeSchema", "true").parquet(f"{output}/data").select("a", "job_id", "batch"), "batch", "job_id")


@pytest.fixture
def places(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")


def test_files_are_cleaned_once_by_content(spark, places):
    folder, output, state = places
    (folder / "one.csv").write_text("a,link\n1,x/1\n2,x/2\n")
    (folder / "again.csv").write_text("a,link\n1,x/1\n2,x/2\n")
    assert clean_stream(spark, str(folder), output, state) == [0]
    assert cleaned(spark, output) == [(1, 1, 0), (2, 2, 0)]
    assert clean_stream(spark, str(folder), output, state) == []
    # Touched, moved and copied files are entered only.
    os.utime(folder / "one.csv", (2_000_000_000, 2_000_000_000))
    os.rename(folder / "again.csv", folder / "sub" / "moved.csv")
    (folder / "copy.csv").write_text("a,link\n1,x/1\n2,x/2\n")
    (folder / "other.csv").write_text("a,link\n1,x/1\n3,x/3\n")
    (folder / "no.txt").write_text("a,link\n9,x/9\n")
    assert clean_stream(spark, str(folder), output, state) == [1]
    assert cleaned(spark, output) == [(1, 1, 0), (2, 2, 0), (1, 1, 1), (3, 3, 1)]
    ledger = spark.read.parquet(f"{state}/ledger").collect()
    name = lambda p: p and p.rsplit("/", 1)[1]
    assert sorted((r.batch, name(r.path), name(r.same_as), r.lines) for r in ledger) == [
        (0, "again.csv", None, 3), (0, "one.csv", "again.csv", 3), (1, "copy.csv", "again.csv", 3), (1, "moved.csv", "again.csv", 3), (1, "other.csv", None, 3)]


def test_only_known_files_make_no_batch(spark, places):
    folder, output, state = places
    (folder / "one.csv").write_text("a,link\n1,x/1\n")
    assert clean_stream(spark, str(folder), output, state) == [0]
    (folder / "two.csv").write_text("a,link\n1,x/1\n")
    assert clean_stream(spark, str(folder), output, state) == []
    (folder / "three.csv").write_text("a,link\n5,x/5\n")
    assert clean_stream(spark, str(folder), output, state) == [2]
    assert cleaned(spark, output) == [(1, 1, 0), (5, 5, 2)]


@pytest.mark.parametrize("where", ["clean", "write"])
def test_a_lost_batch_is_run_again(spark, places, monkeypatch, where):
    folder, output, state = places
    (folder / "one.csv").write_text("a,link\n1,x/1\n")
    assert clean_stream(spark, str(folder), output, state) == [0]
    (folder / "two.csv").write_text("a,link\n2,x/2\n")
    (folder / "one-again.csv").write_text("a,link\n1,x/1\n")
    real = incremental.clean_files

    def lost(*args, **options):
        if where == "write":
            real(*args, **options).data.write.mode("overwrite").parquet(f"{output}/data/batch=1")
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "clean_files", lost)
    with pytest.raises(Exception, match="lost"):
        clean_stream(spark, str(folder), output, state)
    monkeypatch.undo()
    (folder / "three.csv").write_text("a,link\n3,x/3\n")
    assert clean_stream(spark, str(folder), output, state) == [1, 2]
    assert cleaned(spark, output) == [(1, 1, 0), (2, 2, 1), (3, 3, 2)]


def test_batches_of_few_files(spark, places):
    folder, output, state = places
    for i in range(5):
        (folder / f"f{i}.csv").write_text(f"a,link\n{i},x/{i}\n")
    done = clean_stream(spark, str(folder), output, state, max_files=2)
    assert len(done) == 3 and sorted(r[:2] for r in cleaned(spark, output)) == [(i, i) for i in range(5)]


def test_content(spark):
    data = [("p", "h", 1), ("p", "x", 2), ("p", "y", 3), ("q", "h", 1), ("q", "y", 2), ("q", "x", 3), ("r", "h", 1), ("r", "x", 2), ("r", "x", 3),
            ("s", "x", 1), ("s", "h", 2), ("s", "y", 3), ("t", "h", 1), ("t", "x", 2), ("u", "", 1), ("v", None, 1)]
    found = {r.path: r.content for r in content(spark.createDataFrame(data, "path string, value string, place int")).collect()}
    assert found["p"] == found["q"] and len(set(found.values())) == 6
