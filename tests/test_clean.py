"""The cleaning plan end to end: rows, report, status."""

import datetime as dt

from conftest import column, rows

from millrace import CleanOptions, clean_files, clean_table
from millrace.operators import reports


def report(batch, source=None):
    frame = batch.report if source is None else batch.report.filter(batch.report.source_file == source)
    return rows(frame.select(
        "original_column", "missing_percent_before", "cleaned_column", "action", "details", "position"
    ).orderBy("position").drop("position"))


def test_two_row_file(spark, folder):
    batch = clean_files(spark, folder({"test.csv": "col1,col2\n1,2\n3,4"}))
    assert batch.data.dtypes == [
        ("col1", "bigint"), ("col2", "bigint"), ("job_id", "bigint"), ("source_file", "string")]
    assert rows(batch.data, "col1") == [(1, 2, None, "test.csv"), (3, 4, None, "test.csv")]
    assert report(batch) == [
        ("col1", 0.0, "col1", "Kept", ""), ("col2", 0.0, "col2", "Kept", ""), ("job_id", 0.0, "job_id", "Kept", "")]


# Twenty exports of a job list. The last row is one field short, so its values sit one
# column to the left: a zip code lands in the state column.
def job_list():
    header = "Full URL,Customer / Name,State,Zipcode,Owes,Alt rep,Claims extension,Date signed,Unnamed note,"
    lines = [header]
    for i in range(19):
        owes = "" if i == 3 else "$0.00" if i % 2 else "$5.00"
        rep = "someone" if i == 0 else "N/A"
        extension = ["", "1200", "3456", "9000"][i % 4]
        signed = "" if i in (4, 9) else f"2024-01-{10 + i // 2}"
        lines.append(f"https://jobs.example/j/{10001 + i},n{i},UT,84{100 + i},{owes},{rep},{extension},{signed},x,y")
    lines.append('"no digits here",84043,,$5.00,,3456,2024-01-30,x,y')
    return "\n".join(lines) + "\n"


def test_a_shifted_row_spoils_its_columns(spark, folder):
    batch = clean_files(spark, folder({"jobs.csv": job_list()}))
    assert report(batch) == [
        ("Full URL", 0.0, "full_url", "Dropped", "Dropped after job_id extraction"),
        ("Customer / Name", 0.0, "customer_name", "Kept", "Type changed to numeric"),
        ("State", 5.0, "state", "Filled", "Filled with mode ('UT')"),
        ("Zipcode", 0.0, "zipcode", "Kept", "Type changed to numeric"),
        ("Owes", 10.0, "owes", "Filled", "Filled with mode ('$5.00')"),
        ("Alt rep", 90.0, "alt_rep", "Filled", "Filled with mode ('3456') | Type changed to numeric"),
        ("Claims extension", 25.0, "claims_extension", "Filled",
         "Filled with mode ('1200') | Type changed to numeric"),
        ("Date signed", 10.0, "date_signed", "Filled",
         "Filled with mode ('2024-01-10') | Type changed to datetime"),
        ("Unnamed note", 0.0, "unnamed_note", "Dropped", "Dropped after job_id extraction"),
        ("Unnamed: 9", 5.0, "unnamed_9", "Dropped", "Dropped after job_id extraction"),
        ("job_id", 0.0, "job_id", "Kept", ""),
    ]
    states = column(batch.data, "customer_name")
    assert sorted(states, key=str) == [84043.0, *[None] * 19]
    assert batch.data.filter("job_id IS NOT NULL").count() == 19


def test_report_of_a_file_with_everything(spark, folder):
    text = (
        "Job Link,Amount,Label,Created Date,Rare,Flag,Hours,,Code\n"
        "x/jobs/1,5,x,2024-01-10,,True,1,u,7\n"
        "x/jobs/2,,y,,,False,2.5,u,ID\n"
        "x/jobs/3,8,,2024-01-11,,,3,u,7\n"
        "x/jobs/3,8,x,2024-01-11,,True,3,u,7\n"
        + "".join(f"x/jobs/{i},1,z,01/02/2024,,true,{i},u,\n" for i in range(10, 17))
        + ",12,Subtotal,,zz,,,,Account\n"
    )
    batch = clean_files(spark, folder({"all.csv": text}))
    assert report(batch) == [
        ("Job Link", 8.33, "job_link", "Dropped", "Dropped after job_id extraction"),
        ("Amount", 8.33, "amount", "Filled", "Filled with median (1.0)"),
        ("Label", 8.33, "label", "Filled", "Filled with mode ('z')"),
        ("Created Date", 16.67, "created_date", "Filled",
         "Filled with mode ('01/02/2024') | Type changed to datetime"),
        ("Rare", 91.67, "rare", "Dropped", "Dropped (>90% missing)"),
        ("Flag", 16.67, "flag", "Filled", "Filled with mode ('True')"),
        ("Hours", 8.33, "hours", "Kept", ""),
        ("Unnamed: 7", 8.33, "unnamed_7", "Dropped", "Dropped after job_id extraction"),
        ("Code", 58.33, "code", "Filled", "Filled with mode ('7') | Type changed to numeric"),
        ("job_id", 0.0, "job_id", "Kept", ""),
    ]
    assert batch.data.dtypes == [
        ("amount", "double"), ("label", "string"), ("created_date", "timestamp_ntz"), ("flag", "boolean"),
        ("hours", "double"), ("code", "double"), ("job_id", "bigint"), ("source_file", "string")]
    got = rows(batch.data.filter("job_id < 10"), "job_id", "label")
    day = dt.datetime(2024, 1, 10)
    assert got[0] == (5.0, "x", day, True, 1.0, 7.0, 1, "all.csv")
    assert got[1][0] == 1.0 and got[1][2] is None and got[1][5] is None  # mode's format differs
    status = batch.status.first()
    assert (status.raw_rows, status.summary_rows, status.duplicate_rows, status.cleaned_rows, status.keys_found) == (
        12, 1, 0, 11, 11)


def test_text_in_a_numeric_column_costs_the_median(spark, folder):
    batch = clean_files(spark, folder({"t.csv": "label,v\nx,1\ny,2\nz,\nw,2\nSubtotal,Total\n"}))
    assert report(batch)[1] == ("v", 20.0, "v", "Filled", "Filled with mode ('2') | Type changed to numeric")
    assert rows(batch.data.select("v"), "v") == [(1,), (2,), (2,), (2,)]
    assert dict(batch.data.dtypes)["v"] == "bigint"


def test_blank_summary_row_makes_integers_doubles(spark, folder):
    batch = clean_files(spark, folder({"t.csv": "label,v\nx,1\ny,2\nSubtotal,\n"}))
    assert dict(batch.data.dtypes)["v"] == "double"
    assert report(batch)[1] == ("v", 33.33, "v", "Kept", "")


def test_rows_equal_after_filling_collapse(spark, folder):
    batch = clean_files(spark, folder({"t.csv": "a,b\nx,1\nx,\nx,1\ny,1\n"}))
    assert rows(batch.data.select("a", "b"), "a") == [("x", 1.0), ("y", 1.0)]
    assert batch.status.first().duplicate_rows == 2


def test_ninety_percent_is_filled_and_more_is_dropped(spark, folder):
    lines = ["k,at90,at95"] + [f"r{i},{'v' if i < 2 else ''},{'v' if i < 1 else ''}" for i in range(20)]
    batch = clean_files(spark, folder({"t.csv": "\n".join(lines)}))
    assert batch.data.columns == ["k", "at90", "job_id", "source_file"]
    assert [r[3] for r in report(batch)] == ["Kept", "Filled", "Dropped", "Kept"]


def test_hourly_rate_is_taken_for_a_url(spark, folder):
    batch = clean_files(spark, folder({"t.csv": "hourly_rate,x\n12.5,a\n1e5,b\n.5,c\n"}))
    assert rows(batch.data.select("x", "job_id"), "x") == [("a", 12), ("b", 100000), ("c", 0)]
    named = clean_files(spark, folder({"t.csv": "hourly_rate,ref\n12.5,r7\n"}, "b"), url="ref")
    assert rows(named.data.select("hourly_rate", "job_id")) == [(12.5, 7)]


def test_existing_key_is_overwritten(spark, folder):
    batch = clean_files(spark, folder({"t.csv": "job_id,x\n5,a\n,b\n"}))
    assert batch.data.columns == ["job_id", "x", "source_file"]
    assert column(batch.data, "job_id") == [None, None]
    assert report(batch) == [("job_id", 50.0, "job_id", "Kept", ""), ("x", 0.0, "x", "Kept", "")]


def test_each_file_by_its_own_statistics(spark, folder):
    batch = clean_files(spark, folder({
        "a.csv": "v,when date,t\n1,2024-01-10,\n3,01/02/2024,p\n,2024-01-10,p\n",
        "b.csv": "v,when date,t\nx,01/02/2024,q\n10,2024-01-10,q\n,01/02/2024,\n",
        "c.csv": "other\n1\n2\n",
        "d.csv": "v,when date,t\n",
    }))
    one, two = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 2)
    got = sorted(rows(batch.data.select("source_file", "v", "when_date", "t", "other")), key=str)
    assert got == sorted([
        ("a.csv", 1.0, one, "p", None), ("a.csv", 3.0, None, "p", None), ("a.csv", 2.0, one, "p", None),
        ("b.csv", 10.0, two, "q", None), ("b.csv", 10.0, None, "q", None), ("b.csv", None, two, "q", None),
        ("c.csv", None, None, None, 1), ("c.csv", None, None, None, 2)], key=str)
    assert report(batch, "a.csv")[0] == ("v", 33.33, "v", "Filled", "Filled with median (2.0)")
    assert report(batch, "b.csv")[0] == ("v", 33.33, "v", "Filled", "Filled with mode ('10') | Type changed to numeric")
    assert report(batch, "d.csv")[0] == ("v", None, "v", "Kept", "")
    assert batch.data.columns[-2:] == ["job_id", "source_file"]


def test_columns_dropped_or_typed_differently_by_file(spark, folder):
    sparse = "k,v\n" + "".join(f"r{i},{'x' if i == 0 else ''}\n" for i in range(20))
    batch = clean_files(spark, folder({"a.csv": sparse, "b.csv": "k,v\n1,2.5\n2,\n", "c.csv": "k,v\nz,word\n"}))
    kinds = dict(batch.data.dtypes)
    assert kinds["v"] == "string" and kinds["k"] == "string"
    got = rows(batch.data.filter("source_file <> 'a.csv'").select("k", "v"), "k")
    assert got == [("1", "2.5"), ("2", "2.5"), ("z", "word")]
    assert column(batch.data.filter("source_file = 'a.csv'").select("v").distinct(), "v") == [None]


def test_failures_are_per_file(spark, folder):
    batch = clean_files(spark, folder({"ok.csv": "a,b\n1,2\n", "clash.csv": "a,A!\n1,2\n", "empty.csv": ""}))
    status = {r.file_name: r for r in batch.status.collect()}
    assert status["ok.csv"].success and status["ok.csv"].cleaned_rows == 1
    assert not status["empty.csv"].success and status["empty.csv"].error == "Failed to process file"
    assert "'a'" in status["clash.csv"].error
    assert rows(reports.batch_summary(batch.status)) == [(1, 2, 1, 0)]
    assert column(reports.failures(batch.status), "file_name", "file_name") == ["clash.csv", "empty.csv"]
    table = {r.file_name: r for r in reports.file_table(batch.status).collect()}
    assert tuple(table["ok.csv"])[1:] == ("Valid", "2 columns", "0.00 MB")
    assert table["empty.csv"].size == "N/A"
    suffixed = clean_files(spark, folder({"clash.csv": "a,A!\n1,2\n"}, "s"), on_clash="suffix")
    assert suffixed.data.columns == ["a", "a_2", "job_id", "source_file"]


def test_no_readable_file(spark, folder):
    batch = clean_files(spark, folder({"empty.csv": ""}))
    assert rows(batch.status.select("file_name", "success", "error")) == [
        ("empty.csv", False, "Failed to process file")]
    assert batch.data.count() == 0 and batch.report.count() == 0


def test_skipped_files_say_so(spark, folder):
    path = folder({"a.csv": "a,b,c\n1,2,3\n", "b.csv": "a,b,c\n1,2,3\n", "odd.csv": "x,y\n1,2\n"})
    batch = clean_files(spark, path, schema_handling="skip")
    assert rows(batch.status.filter("not success").select("file_name", "error")) == [
        ("odd.csv", "Skipped for lack of columns most files have")]


def test_typed_table(spark):
    data = [("f", 1, "u/1", 1.0, "5", dt.datetime(2024, 1, 1), True), ("f", 2, "u/2", None, "x", None, None),
            ("f", 3, None, 4.0, None, dt.datetime(2024, 1, 1), False), ("f", 4, "u/4", float("nan"), "5", None, True)]
    frame = spark.createDataFrame(
        data, "f string, i int, link string, v double, t string, at timestamp_ntz, b boolean")
    batch = clean_table(frame, source="f", order="i")
    assert batch.data.dtypes == [
        ("v", "double"), ("t", "double"), ("at", "timestamp_ntz"), ("b", "boolean"), ("job_id", "bigint"),
        ("source_file", "string")]
    got = sorted(rows(batch.data.select("v", "t", "b", "job_id")), key=str)
    assert got == sorted([(1.0, 5.0, True, 1), (2.5, None, True, 2), (4.0, 5.0, False, None), (2.5, 5.0, True, 4)], key=str)
    details = {r[2]: r[4] for r in report(batch)}
    assert details["at"] == "Filled with mode ('2024-01-01 00:00:00')"
    assert details["b"] == "Filled with mode ('True')"


def test_share_option_keeps_mostly_text_columns(spark, folder):
    path = folder({"t.csv": "a,b\nUT,1\n84043,2\nUT,3\n"})
    strict = clean_files(spark, path, options=CleanOptions(numeric_min_share=0.5))
    assert dict(strict.data.dtypes)["a"] == "string"
    assert dict(clean_files(spark, path).data.dtypes)["a"] == "double"


def test_rejected_values_and_the_rest_are_all_cells(spark, folder):
    """What is null in the result was missing, or is a rejected value with its place."""
    from millrace.plans.clean import fill_counts

    text = "Link,amount,Start Date,plain\nx/1,5,2024-01-02,a\nx/2,oops,2024-13-02,b\nx/99999999999999999999,7.5,,c\nnone,True,2024-01-05,d\nx/5,,nope,e\n"
    other = "Link,amount,Start Date,plain\nx/7,words,01/02/2024,a\nx/8,more,01/03/2024,b\n"
    batch = clean_files(spark, folder({"a.csv": text, "b.csv": other}))
    found = batch.rejected_values.collect()
    got = {(r.source_file, r["column"], r.value, r.reason) for r in found}
    assert got == {
        ("a.csv", "amount", "oops", "not a number"), ("a.csv", "amount", "True", "not a number"),
        ("a.csv", "start_date", "2024-13-02", "not a date in the column's format"), ("a.csv", "start_date", "nope", "not a date in the column's format"),
        ("a.csv", "link", "x/99999999999999999999", "key beyond 64 bits"),
    }
    places = {(r.source_file, r["column"], r.value): r.row for r in found}
    order = [places["a.csv", "amount", "oops"], places["a.csv", "link", "x/99999999999999999999"], places["a.csv", "amount", "True"], places["a.csv", "start_date", "nope"]]
    assert order == sorted(order) and len(set(order)) == 4
    lost = batch.data.filter("source_file = 'a.csv'").selectExpr("count_if(amount IS NULL) AS a", "count_if(start_date IS NULL) AS d", "count_if(job_id IS NULL) AS k").first()
    assert (lost.a, lost.d, lost.k) == (2, 2, 2)
    filled = {(r.source_file, r["column"], r.fill, r.filled, r.value) for r in fill_counts(batch).collect()}
    assert filled == {("a.csv", "amount", "mode", 1, "5"), ("a.csv", "start_date", "mode", 1, "2024-01-02")}


def test_no_rejected_values(spark, folder):
    batch = clean_files(spark, folder({"a.csv": "a,b\n1,x\n2,y\n"}))
    assert batch.rejected_values.collect() == [] and batch.rejected_values.columns == ["source_file", "row", "column", "value", "reason"]
    assert clean_files(spark, folder({"bad.csv": 'a,b\n1,"x\n'}, "only")).rejected_values is None
