"""Master dataset, its report, saving and loading, incremental runs."""

from datetime import datetime

import pytest
from conftest import column, rows

from millrace import TableTarget, build_master, clean_files, load_table, save_master, validate_target
from millrace.streaming.incremental import clean_new_files, current

FILES = {
    "a.csv": "link,x\nu/1,p\nu/2,q\n",
    "b.csv": "link,x,y\nu/2,r,7\nu/3,s,8\nu/2,t,9\n",
    "c.csv": "link,x\nu/2,w\nu/4,v\n",
    "d.csv": "link,x\n",
}


@pytest.fixture
def batch(spark, folder):
    return clean_files(spark, folder(FILES))


def test_outer(batch):
    master = build_master(batch, "outer")
    assert master.merge_info == "Outer join merge of 3 files"
    assert master.data.columns == ["x", "job_id", "source_file", "y"]
    assert sorted(rows(master.data), key=str) == sorted([
        ("p", 1, "a.csv", None), ("q", 2, "a.csv", 7), ("q", 2, "a.csv", 9), (None, 3, None, 8),
        (None, 4, None, None)], key=str)
    found = {(r.section, r.metric): r.value for r in master.report.collect()}
    assert found[("Dataset Overview", "Total Rows")] == "5"
    assert found[("Dataset Overview", "Source Files")] == "1"
    # Only the first file's rows keep a source.
    assert found[("Records per Source File", "a.csv")] == "3"
    assert found[("Data Quality Alerts", "source_file")] == "2"
    assert ("Data Quality Alerts", "job_id") not in found


def test_inner_and_concat(batch):
    inner = build_master(batch, "inner")
    assert inner.merge_info == "Inner join merge of 3 files"
    assert sorted(rows(inner.data)) == [("q", 2, "a.csv", 7), ("q", 2, "a.csv", 9)]
    concat = build_master(batch, "concat")
    assert concat.merge_info == "Concatenated 3 files without merging"
    assert concat.data.count() == 7
    with pytest.raises(ValueError, match="unknown merge"):
        build_master(batch, "left")


def test_one_file_and_none(spark, folder):
    one = build_master(clean_files(spark, folder({"a.csv": "link,x_dup\nu/1,p\n"})))
    assert one.merge_info == "Single file - no merging needed"
    assert one.data.columns == ["x_dup", "job_id", "source_file"]
    none = build_master(clean_files(spark, folder({"a.csv": "link,x\n"}, "e")))
    assert (none.data, none.merge_info) == (None, "No valid dataframes to merge")


def test_save(spark, batch, tmp_path):
    master = build_master(batch, "outer")
    now = datetime(2024, 5, 6, 7, 8, 9)
    target = TableTarget("p-1", "millrace_test", "master", location=str(tmp_path / "db"))
    saved = save_master(master, str(tmp_path / "out"), target=target, now=now)
    assert saved["csv_file"].endswith("/master_job_data_20240506_070809.csv")
    assert saved["report_file"].endswith("/master_job_data_report_20240506_070809.csv")
    assert saved["csv_size_mb"] > 0
    assert (saved["table_success"], saved["table"], saved["table_rows"]) == (True, "p-1.millrace_test.master", 5)
    again = spark.read.option("header", "true").csv(saved["csv_file"])
    assert again.columns == master.data.columns and again.count() == 5
    assert spark.read.option("header", "true").csv(saved["report_file"]).columns == ["section", "metric", "value"]
    refused = save_master(master, str(tmp_path / "out2"), target=TableTarget("p"), now=now)
    assert refused["table_success"] is False and "Configuration error" in refused["table_error"]


def test_load_overwrites_schema_and_counts(spark, tmp_path):
    target = TableTarget("test-project", "millrace_load", "t", location=str(tmp_path / "db"))
    frame = spark.createDataFrame([(1, 3), (2, 4)], "col1 bigint, col2 bigint")
    assert load_table(frame, target) == {
        "success": True, "table_id": "test-project.millrace_load.t", "rows_uploaded": 2, "columns_uploaded": 2}
    other = spark.createDataFrame([("x",)], "name string")
    assert load_table(other, target)["rows_uploaded"] == 1
    assert rows(spark.table("millrace_load.t")) == [("x",)]


def test_load_to_a_folder_with_quotes(spark, tmp_path):
    target = TableTarget("p", "millrace_quoted", "t", location=str(tmp_path / "it's here"))
    assert load_table(spark.createDataFrame([(1,)], "a int"), target)["success"]
    assert (tmp_path / "it's here" / "t").exists()


def test_a_load_is_tried_again(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    real, calls = DataFrameWriter.saveAsTable, []

    def failing(self, name, *more, **options):
        calls.append(name)
        if len(calls) < 3:
            raise RuntimeError("lost")
        return real(self, name, *more, **options)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", failing)
    target = TableTarget("p", "millrace_again", "t", location=str(tmp_path / "db"))
    assert load_table(spark.createDataFrame([(1,)], "a int"), target)["success"] and len(calls) == 3


def test_a_load_that_fails_midway_leaves_the_old_rows(spark, tmp_path):
    target = TableTarget("p", "millrace_kept", "t", location=str(tmp_path / "db"))
    assert load_table(spark.createDataFrame([(i, "old") for i in range(50)], "a int, b string"), target)["success"]
    broken = spark.range(1000, numPartitions=8).selectExpr("id", "CASE WHEN id = 777 THEN raise_error('lost') ELSE 'new' END AS c")
    outcome = load_table(broken, target, retries=2)
    assert not outcome["success"] and "after 2 attempts" in outcome["error"]
    kept = spark.table("millrace_kept.t")
    assert kept.columns == ["a", "b"] and kept.count() == 50
    assert [t.name for t in spark.catalog.listTables("millrace_kept")] == ["t"] and [p.name for p in (tmp_path / "db").iterdir()] == ["t"]


def test_a_swap_that_fails_brings_the_old_table_back(spark, tmp_path, monkeypatch):
    target = TableTarget("p", "millrace_swap", "t", location=str(tmp_path / "db"))
    assert load_table(spark.createDataFrame([(1,)], "a int"), target)["success"]
    real, kind = type(spark).sql, type(spark)

    def failing(self, text, *more, **options):
        if "__new_" in text and "RENAME" in text:
            raise RuntimeError("no rename")
        return real(self, text, *more, **options)

    monkeypatch.setattr(kind, "sql", failing)
    assert "no rename" in load_table(spark.createDataFrame([(2,), (3,)], "a int"), target, retries=1)["error"]
    monkeypatch.undo()
    assert rows(spark.table("millrace_swap.t")) == [(1,)] and [t.name for t in spark.catalog.listTables("millrace_swap")] == ["t"]
    assert load_table(spark.createDataFrame([(2,), (3,)], "a int"), target)["rows_uploaded"] == 2
    assert spark.table("millrace_swap.t").count() == 2


def test_load_failures(spark, tmp_path):
    frame = spark.createDataFrame([(1,)], "a int")
    refused = load_table(frame, TableTarget(project="test"))
    assert not refused["success"] and "Configuration validation failed" in refused["error"]
    bad = TableTarget("p", "millrace_bad", "t", format="no-such-format", location=str(tmp_path / "db"))
    assert load_table(frame, bad, retries=2)["error"].startswith("Upload failed after 2 attempts: ")
    missing = TableTarget("p1", "d", "t", catalog=True)
    assert load_table(frame, missing)["error"].startswith("Failed to create dataset p1.d: ")


@pytest.mark.parametrize("project, dataset, table, valid, word", [
    ("my-project-123", "my_dataset", "my_table", True, "valid"), ("", "my_dataset", "my_table", False, "project"),
    ("my-project", "", "my_table", False, "dataset"), ("my-project", "my_dataset", "", False, "table"),
    ("my-project", "123invalid", "my_table", False, "dataset"), ("-", "d", "t", True, "valid"),
    ("a-", "d", "t", False, "project"), ("p", "d", "t-1", False, "table"),
    ("p", "d\n", "t", False, "dataset"), ("pp\n", "d", "t", False, "project"),
])
def test_target_validation(project, dataset, table, valid, word):
    outcome, message = validate_target(TableTarget(project, dataset, table))
    assert outcome is valid and word in message
    assert validate_target(None)[0] is False


def test_only_new_files_are_cleaned(spark, folder, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    path = folder({"a.csv": FILES["a.csv"]})
    clean_new_files(spark, path, out, ledger)
    folder({"b.csv": FILES["b.csv"]})
    clean_new_files(spark, path, out, ledger)
    clean_new_files(spark, path, out, ledger)
    status = spark.read.parquet(f"{out}/status")
    assert rows(status.select("batch", "file_name", "cleaned_rows"), "batch") == [(0, "a.csv", 2), (1, "b.csv", 3)]
    data = spark.read.option("mergeSchema", "true").parquet(f"{out}/data")
    assert column(data, "job_id", "job_id") == [1, 2, 2, 2, 3]


def test_changed_files_are_cleaned_again(spark, folder, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    path = folder({"a.csv": "id,link\n1,x/1\n", "b.csv": "id,link\n5,x/5\n", "none.csv": ""})
    assert clean_new_files(spark, path, out, ledger, max_files=2) == 2
    assert clean_new_files(spark, path, out, ledger) == 0
    folder({"a.csv": "id,link\n1,x/1\n2,x/2\n"})
    assert clean_new_files(spark, path, out, ledger) == 1
    assert column(current(spark, out), "job_id", "job_id") == [1, 2, 5]
    assert sorted(column(current(spark, out, "status"), "source_file")) == ["a.csv", "b.csv", "none.csv"]


def test_files_of_equal_names_in_two_folders_are_kept(spark, folder, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    path = folder({})
    folder({"part-0.csv": "id,link\n1,x/1\n", "only.csv": "id,link\n9,x/9\n"}, "in/day=1")
    assert clean_new_files(spark, path, out, ledger) == 1
    folder({"part-0.csv": "id,link\n2,x/2\n"}, "in/day=2")
    assert clean_new_files(spark, path, out, ledger) == 1
    found = rows(current(spark, out).select("job_id", "source_file"), "job_id")
    assert [(k, s.rsplit("/in/")[-1]) for k, s in found] == [(1, "day=1/part-0.csv"), (2, "day=2/part-0.csv"), (9, "only.csv")]
    assert {s for _, s in found} == set(column(current(spark, out, "status"), "source_file")) == set(column(current(spark, out, "report"), "source_file"))
    # Both change in one batch, where the names clash; then one of them alone.
    folder({"part-0.csv": "id,link\n1,x/1\n3,x/3\n"}, "in/day=1")
    folder({"part-0.csv": "id,link\n2,x/2\n4,x/4\n"}, "in/day=2")
    assert clean_new_files(spark, path, out, ledger) == 1
    folder({"part-0.csv": "id,link\n5,x/5\n"}, "in/day=2")
    assert clean_new_files(spark, path, out, ledger) == 1
    assert column(current(spark, out), "job_id", "job_id") == [1, 3, 5, 9]
