"""Cleaning rules as data: per file, per column, which rule counts, renames, errors."""

import pytest
from conftest import rows

from millrace.plans.clean import CleanOptions, clean_files
from millrace.plans.rules import RULES


def cleaned(spark, path, rules, **options):
    return clean_files(spark, path, options=CleanOptions(rules=spark.createDataFrame(rules, RULES), **options))


FILES = {
    "east.csv": "Link,Cust,amount,note\nx/1,a,1,ok\nx/2,b,oops,Grand sum\nx/3,,3,ok\n",
    "west.csv": "Link,Customer,amount,note\nx/4,c,4,total summary\nx/5,d,,sum of all\nx/6,e,6,fine\n",
}


def test_two_files_under_unlike_rules(spark, folder):
    batch = cleaned(spark, folder(FILES), [
        ("east%", "rename", "cust", "customer"), ("east%", "summary_word", None, "GRAND SUM"), ("west%", "drop", "note", None),
        ("west%", "sparse_percent", "amount", "10"), (None, "numeric_min_share", None, "0.9"),
    ])
    assert sorted(batch.data.columns) == ["amount", "customer", "job_id", "note", "source_file"]
    got = rows(batch.data.select("job_id", "customer", "amount", "note", "source_file"), "job_id")
    assert got == [
        (1, "a", 1, "ok", "east.csv"), (3, "a", 3, "ok", "east.csv"),
        (5, "d", None, None, "west.csv"), (6, "e", None, None, "west.csv")]
    report = {(r.source_file, r.original_column): (r.cleaned_column, r.action, r.details) for r in batch.report.collect()}
    assert report["east.csv", "Cust"][0] == "customer" and report["west.csv", "note"] == ("note", "Dropped", "Dropped by rule")
    assert report["west.csv", "amount"][1] == "Dropped"


def test_without_rules_for_any_file_nothing_changes(spark, folder):
    path = folder(FILES)
    plain = clean_files(spark, path)
    for rules in ([], [("north%", "drop", "note", None)]):
        ruled = cleaned(spark, path, rules)
        assert ruled.data.columns == plain.data.columns
        assert sorted(rows(ruled.data), key=repr) == sorted(rows(plain.data), key=repr)
        assert sorted(rows(ruled.report), key=repr) == sorted(rows(plain.report), key=repr)


def test_the_longest_pattern_counts(spark, folder):
    path = folder({"a1.csv": "x,y\n1,\n2,\n3,5\n", "a2.csv": "x,y\n1,\n2,\n3,5\n", "b.csv": "x,y\n1,\n2,\n3,5\n"})
    batch = cleaned(spark, path, [(None, "sparse_percent", None, "50"), ("a%", "sparse_percent", None, "80"), ("a2%", "sparse_percent", "y", "20"), ("%", "rename", "x", "n"), ("a%", "rename", "x", "m"), ("a%", "rename", "x", "k")])
    actions = {r.source_file: r.action for r in batch.report.filter("original_column = 'y'").collect()}
    assert actions == {"a1.csv": "Filled", "a2.csv": "Dropped", "b.csv": "Dropped"}
    got = {(r.source_file, r.m, r.n) for r in batch.data.collect()}
    assert got == {(f, x, None) for f in ("a1.csv", "a2.csv") for x in (1, 2, 3)} | {("b.csv", None, x) for x in (1, 2, 3)}


def test_swapped_names_and_types(spark, folder):
    path = folder({"a.csv": "p,q\n1,u\n2,v\n", "b.csv": "p,q\n3.5,w\n4.5,z\n"})
    batch = cleaned(spark, path, [("a%", "rename", "p", "q"), ("a%", "rename", "q", "p")])
    got = {(r.source_file, r.p, r.q) for r in batch.data.collect()}
    assert got == {("a.csv", "u", "1.0"), ("a.csv", "v", "2.0"), ("b.csv", "3.5", "w"), ("b.csv", "4.5", "z")}


@pytest.mark.parametrize("rule, problem", [
    ((None, "paint", "a", "b"), "unknown kind"), ((None, None, "a", "b"), "unknown kind"), ((None, "drop", None, None), "no column"),
    ((None, "rename", "a", " "), "no value"), ((None, "rename", "a", "job_id"), "taken"), ((None, "summary_word", None, None), "no value"),
    ((None, "sparse_percent", None, "120"), "percentage"), ((None, "sparse_percent", None, "x"), "percentage"), ((None, "numeric_min_share", None, "2"), "share"),
])
def test_rules_that_make_no_sense(spark, folder, rule, problem):
    with pytest.raises(ValueError, match=problem):
        cleaned(spark, folder({"a.csv": "a,b\n1,2\n"}), [rule])
