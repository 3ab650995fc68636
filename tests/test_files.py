"""Assessment, CSV scans, schema checks."""

import contextlib
import re

import pandas as pd
import pytest
from conftest import column, rows

from millrace import clean_files
from millrace.sources import schema
from millrace.sources.assess import assess_files
from millrace.sources.csv_files import header_lines, stage_csv


def test_assess_two_row_file(spark, folder):
    row = assess_files(spark, folder({"test.csv": "col1,col2\n1,2\n3,4"})).first()
    assert (row.file_name, row.working_encoding, row.likely_delimiter, row.issues_found) == (
        "test.csv", "utf-8", ",", [])
    assert (row.lines, row.max_commas, row.multi_line) == (3, 1, False)


def test_assess_odd_files(spark, folder):
    path = folder({
        "a empty.csv": "", "b.csv": "\n\n", "c.csv": b"a,b\n1,caf\xe9\n",
        "d.csv": "a,b,c\n1,2,3\n4,5\n6,7,8,9\n", "e.csv": 'a,b\n"x\ny",1\n', "f.csv": 'a,b\n"x,y",1\n5" q,2\n',
        "g.csv": "a,b\n" + "1,2\n" * 30 + "1,2,3\n", "skip.txt": "no",
    })
    found = {r.file_name: r for r in assess_files(spark, path).collect()}
    assert sorted(found) == ["a empty.csv", "b.csv", "c.csv", "d.csv", "e.csv", "f.csv", "g.csv"]
    assert found["a empty.csv"].issues_found == ["Failed to decode file."]
    assert found["a empty.csv"].size_mb == 0.0
    assert found["b.csv"].issues_found == ["Pandas read error: No columns to parse from file"]
    assert found["c.csv"].working_encoding == "latin-1"
    assert found["d.csv"].issues_found == [
        "Pandas read error: Error tokenizing data. C error: Expected 3 fields in line 4, saw 4\n"]
    assert found["e.csv"].multi_line and not found["d.csv"].multi_line
    assert not found["f.csv"].multi_line  # a quote that begins no field
    assert found["g.csv"].issues_found == []  # beyond the first ten rows


def cells(staged, *names):
    ids = [staged.columns[staged.names.index(n)] for n in names]
    return rows(staged.data.select(*ids, "_row").orderBy("_row").drop("_row"))


def test_long_rows_are_skipped_and_short_rows_kept(spark, folder):
    staged = stage_csv(spark, folder({"r.csv": "a,b,c\n1,2,3\n4,5\n6,7,8,9\n6,7,8,\n\n  \nx,y,\n"}))
    assert cells(staged, "a", "b", "c") == [("1", "2", "3"), ("4", "5", None), ("x", "y", None)]
    assert column(staged.extras["rejects"], "record", "record") == ["6,7,8,", "6,7,8,9"]


def test_quotes_and_line_breaks(spark, folder):
    staged = stage_csv(spark, folder({"q.csv": 'a,b\n"x\ny",1\n"say ""hi""",\n"",3\n"p,q",4\n'}))
    assert cells(staged, "a", "b") == [("x\ny", "1"), ('say "hi"', None), (None, "3"), ("p,q", "4")]


@contextlib.contextmanager
def split_size(spark, size):
    """Files cut into splits of `size` bytes, or left whole."""
    settings = {"spark.sql.files.maxPartitionBytes": f"{size}b", "spark.sql.files.openCostInBytes": "1b"} if size else {}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def quoted(value):
    return '"' + value.replace('"', '""') + '"' if set(value) & set('",\n\r') else value


@pytest.mark.parametrize("size, encoding, end", [
    (None, "utf-8", "\n"), (700, "utf-8", "\r\n"), (4096, "latin-1", "\n"), (None, "latin-1", "\r\n"), (700, "latin-1", "\r"),
])
def test_records_are_the_same_in_one_split_and_in_many(spark, folder, size, encoding, end):
    texts = ["a", "b\nc", 'say "x"\nand "y"', "plain", "with, comma", "\n\n\n", "é\r\nè", "", "old\rmac", '""', '"']
    data = [[str(i), texts[i * 7 % len(texts)], str(i * 2)] for i in range(600)]
    header = '"Id\r\nno",t,n'
    body = [",".join(map(quoted, row)) for row in data]
    files = {
        "big.csv": end.join([header, *body, '9,"x\ny",1,2', "", "  ", '8,"z\nz"']) + end,
        "odd.csv": 'id,t,n\n1,5" pipe,2\n2,"x\ny",3\n3,"a" b,c"\n4,6" and 7",8\n',
    }
    path = folder({n: t.encode(encoding) for n, t in files.items()})
    with split_size(spark, size):
        staged = stage_csv(spark, path)
        got = rows(staged.data.select("_source", "c0", "c1", "c2").orderBy("_source", "_row"))
    assert staged.headers[0].original == ("Id\r\nno", "t", "n")
    assert got[:600] == [("big.csv", i, t or None, n) for i, t, n in data]
    assert got[600] == ("big.csv", "8", "z\nz", None)
    assert [r[:3] for r in got[601:]][:2] + [got[-1][:3]] == [("odd.csv", None, "5\" pipe"), ("odd.csv", None, "x\ny"), ("odd.csv", None, "6\" and 7\"")]
    assert column(staged.extras["rejects"], "record") == ['9,"x\ny",1,2']


@pytest.mark.parametrize("text", [
    '"Job\nNo",Name,Link\n1,a,x/1\n2,"b\r\nc",x/2\n', 'a,b\r\n"l1\r\nl2",1\r\n \r\n"l1\nl2",2\r\n', 'a,b\r"l1\rl2",1\r\rx,2\r',
    'a,b\n"x""\n""y",1\n"",2\n"""",3\n', 'a,b\n1,"\n\n"\n\n2,"c,d"\n', 'a,b\n5" q,2\n"x\ny",1\n', 'a\n"x"\n"y\nz"\n',
])
@pytest.mark.parametrize("times, size", [(1, None), (300, 300)])
def test_records_agree_with_a_plain_reader(spark, folder, text, times, size):
    end = re.search("\r\n|\r|\n", text.replace("Job\n", "Job "))
    text = text[: end.end()] + text[end.end() :] * times
    path = folder({"f.csv": text})
    plain = pd.read_csv(f"{path}/f.csv", dtype=str, keep_default_na=False, lineterminator=None)
    with split_size(spark, size):
        staged = stage_csv(spark, path)
        got = rows(staged.data.select(*staged.columns, "_row").orderBy("_row").drop("_row"))
    assert list(staged.headers[0].original) == list(plain.columns)
    assert got == [tuple(v or None for v in r) for r in plain.itertuples(index=False, name=None)]


def test_files_that_cannot_be_read_are_no_success(spark, folder):
    path = folder({"open.csv": 'a,b\n1,"x\n2,3\n', "long.csv": "a,b\n1,2,3\n4,5,6\n", "good.csv": "a,b\n1,2\n", "bare.csv": "a,b\n"})
    status = {r.file_name: r for r in clean_files(spark, path).status.collect()}
    assert {n: r.success for n, r in status.items()} == {"open.csv": False, "long.csv": False, "good.csv": True, "bare.csv": True}
    assert "EOF inside string" in status["open.csv"].issues_found[0] and status["long.csv"].rejected_rows == 2


def test_the_plan_does_not_grow_with_headers(spark, folder):
    def plan(headers):
        names = [f"c{i}" for i in range(12)]
        files = {f"f{i}.csv": ",".join(names[i % 12 :] + names[: i % 12]) + f",n{i % 2}\n1,2,3\n" for i in range(headers)}
        staged = stage_csv(spark, folder(files, f"in{headers}"))
        assert staged.data.count() == headers
        return len(staged.names)

    assert plan(2) == 14 and plan(24) == 14


def test_many_headers_are_one_scan(spark, folder, monkeypatch):
    from millrace.sources import csv_files

    plans = []
    real = csv_files._staged
    monkeypatch.setattr(csv_files, "_staged", lambda rows, headers, names: plans.append(real(rows, headers, names)) or plans[-1])
    for n in (2, 150):
        files = {f"f{i}.csv": ",".join(f"c{(i * k + k) % 7}" for k in range(1, 4 + i % 3)) + ",x" * (i // 50) + f",y{i % 5}\n1,2,3\n" for i in range(n)}
        stage_csv(spark, folder(files, f"in{n}"), on_clash="suffix")
    sizes = [len(re.findall("Scan|Exchange|Join|Project|Union", p._jdf.queryExecution().executedPlan().toString())) for p in plans]
    assert sizes[1] <= sizes[0] + 6


def test_latin1_and_header_with_accents(spark, folder):
    staged = stage_csv(spark, folder({"l.csv": b"a,caf\xe9\n1,cr\xe8me\n"}))
    assert staged.headers[0].original == ("a", "café")
    assert rows(staged.data.select("c1")) == [("crème",)]


def test_files_of_one_header_are_one_read(spark, folder):
    files = {f"f{i}.csv": f"a,link\n{i},x/{i}\n" for i in range(6)} | {"z.csv": "q,r\n1,2\n"}
    path = folder(files)
    assert [(g.header_line, g.files) for g in header_lines(assess_files(spark, path))] == [("a,link", 6), ("q,r", 1)]
    staged = stage_csv(spark, path)
    got = rows(staged.data.select("_source", "c0", "_key").filter("_header = 0"), "_source")
    assert got == [(f"f{i}.csv", str(i), i) for i in range(6)]


def test_same_name_in_two_folders_is_two_files(spark, folder, tmp_path):
    for sub in ("x", "y"):
        (tmp_path / "in" / sub).mkdir(parents=True)
        (tmp_path / "in" / sub / "part.csv").write_text(f"a\n{sub}\n")
    staged = stage_csv(spark, str(tmp_path / "in"))
    sources = column(staged.data, "_source", "_source")
    assert len(sources) == 2 and sources[0].endswith("/x/part.csv")


def test_schema_compatibility(spark):
    few = {"f": ["a", "b", "c"], "g": ["a", "b", "d"]}
    assert schema.check_schema_compatibility(few, spark) == (
        False, ["Files have very few common columns (2)"])
    assert schema.check_schema_compatibility({"f": ["a", "b", "c"], "g": ["c", "b", "a", "x"]}, spark) == (True, [])
    assert schema.check_schema_compatibility({"f": ["a"]}, spark) == (True, [])
    table = schema.column_table(few | {"h": ["Full URL"]}, spark)
    assert rows(schema.url_flags(table), "source_file") == [("f", False), ("g", False), ("h", True)]
    assert column(schema.common_columns(schema.column_table(few, spark)), "column", "column") == ["a", "b"]
    assert rows(schema.all_columns(table), "column")[0] == ("Full URL", 1)


def test_schema_samples(spark, folder):
    staged = stage_csv(spark, folder({
        "a.csv": "n,Flag,t\n" + "1,True,x\n" * 5 + "oops,False,y\n", "b.csv": "n,m\n1,2\n1,2,3\n"}))
    a, b = rows(schema.schema_samples(staged), "source_file")
    assert a == ("a.csv", ["n", "Flag", "t"], {"n": "bigint", "Flag": "boolean", "t": "string"}, 5, None)
    assert b[4] is not None


def test_schema_handling(spark, folder):
    files = {"a.csv": "a,b,c\n1,2,3\n", "b.csv": "a,b,c\n1,2,3\n", "odd.csv": "x,y\n1,2\n"}
    path = folder(files)
    assert stage_csv(spark, path).names == ["a", "b", "c", "x", "y"]
    assert stage_csv(spark, path, schema_handling="skip").names == ["a", "b", "c"]
    with pytest.raises(ValueError, match="very few common columns"):
        stage_csv(spark, path, schema_handling="strict")
