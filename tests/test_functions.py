"""Names, tokens, numbers, dates and keys."""

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import dates, keys, names, values


def mapped(spark, texts, expression, kind="string"):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize("raw, clean", [
    ("Job ID", "job_id"), ("  Total  Price! ", "total_price"), ("Customer / First name", "customer_first_name"),
    ("__a__", "a"), ("a__b", "a__b"), ("É", ""), ("Unnamed: 2", "unnamed_2"), (7, "7"), ("a-_-b", "a___b"),
])
def test_clean_name(raw, clean):
    assert names.clean_name(raw) == clean


@given(st.text(max_size=30))
def test_clean_name_is_idempotent(text):
    once = names.clean_name(text)
    assert names.clean_name(once) == once
    assert set(once) <= set("abcdefghijklmnopqrstuvwxyz0123456789_")


def test_header_names():
    assert names.header_names("a,a,,b") == ["a", "a.1", "Unnamed: 2", "b"]
    assert names.clean_names(names.header_names("a,a,,b")) == ["a", "a_1", "unnamed_2", "b"]
    assert names.header_names('﻿x,"y, z"') == ["x", "y, z"]


def test_name_clash_raises_or_is_numbered():
    with pytest.raises(ValueError, match="'a'"):
        names.clean_names(["A", "a!"])
    assert names.clean_names(["A", "a!", "a?"], "suffix") == ["a", "a_2", "a_3"]


def test_url_column_is_the_first_with_a_url_word_anywhere():
    assert names.find_url_column(["id", "hourly_rate", "url"]) == "hourly_rate"
    assert names.find_url_column(["id", "name"]) is None
    columns = ["a", "unnamed_3", "link"]
    assert names.key_source_columns(columns, "link") == ["unnamed_3", "link"]
    assert names.key_source_columns(columns, None) == []


def test_null_tokens_are_exact(spark):
    others = ["none", "Null", "NONE", "-", " ", " NA", "x"]
    texts = [*values.NULL_TOKENS, *others]
    got = mapped(spark, texts, lambda _: values.nullify("v"))
    assert got == [None] * len(values.NULL_TOKENS) + others


def test_numbers(spark):
    texts = ["1e5", "12.", ".5", "inf", "+3", " 12 ", "\t5\n", "-INF", "1d", "1f", "0x1A", "1,200", "5%",
             "1e400", "１２", "True", "", "-", "1_000", "5e", None]
    infinity = float("inf")
    assert mapped(spark, texts, values.number) == [
        1e5, 12.0, 0.5, infinity, 3.0, 12.0, 5.0, -infinity, *[None] * 13]
    assert mapped(spark, ["007", "+3", " 12 ", "1.0", "9" * 25], values.integer) == [7, 3, 12, None, None]


def test_cell_classes(spark):
    texts = [None, "x", "tRue", "1.5", "12"]
    assert mapped(spark, texts, values.cell_class) == [
        values.MISSING, values.TEXT, values.BOOLEAN, values.NUMBER, values.WHOLE]


def test_percent_rounds_half_to_even(spark):
    frame = spark.createDataFrame([(1, 800), (1, 3), (0, 5), (0, 0)], "a bigint, b bigint")
    got = [r[0] for r in frame.select(values.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [0.12, 33.33, 0.0, None]


@pytest.mark.parametrize("sign", [1, -1])
def test_float_text_is_python_repr(spark, sign):
    numbers = [sign * v for v in (
        1e7, 123456789.5, 1e16, 1.5e16, 1e-4, 1e-5, 0.00012, 12345678.25, 0.5, 1e22, 3456.0, 3e-7, 1e100,
        1.2345678901234567e-5, 9007199254740993.0, 123456.789, float("inf"))] + [0.0]
    assert mapped(spark, numbers, values.float_text, "double") == [repr(v) for v in numbers]


def at(*parts):
    return dt.datetime(*parts)


@pytest.mark.parametrize("texts, parsed", [
    (["2024-01-10", "2024-1-5", "01/02/2024", "2024-02-30", "2024-03-01 10:00", "2024", " 2024-01-11"],
     [at(2024, 1, 10), at(2024, 1, 5), None, None, None, None, None]),
    (["01/02/2024", "1/2/2024", "13/02/2024", "01/02/24"], [at(2024, 1, 2), at(2024, 1, 2), None, None]),
    (["13/02/2024", "1/2/2024", "12/31/2024"], [at(2024, 2, 13), at(2024, 2, 1), None]),
    (["2024-01-10 10:00:00", "2024-01-10 9:00:00", "2024-01-10T10:00:00", "2024-01-10"],
     [at(2024, 1, 10, 10), at(2024, 1, 10, 9), None, None]),
    (["2024-01-10T10:00:00Z", "2024-01-10T10:00:00+02:00"], [at(2024, 1, 10, 10), at(2024, 1, 10, 8)]),
    (["Jan 10, 2024", "JAN 5, 2024", "January 10, 2024"], [at(2024, 1, 10), at(2024, 1, 5), None]),
    (["10-Jan-2024", "1-feb-2024"], [at(2024, 1, 10), at(2024, 2, 1)]),
    (["2024-02-30", "2024-01-10", "01/02/2024"], [None, at(2024, 1, 10), at(2024, 1, 2)]),
    (["bob", "2024-01-10", "01/02/2024", "Jan 5 2024"],
     [None, at(2024, 1, 10), at(2024, 1, 2), at(2024, 1, 5)]),
    (["1/15/2024 10:30:00 AM", "1/5/2024 1:05:09 PM", "1/5/2024 13:05:09", "1/5/2024"],
     [at(2024, 1, 15, 10, 30), at(2024, 1, 5, 13, 5, 9), None, None]),
    (["15-Jan-24", "1-Feb-24", "1/2/24 3:04 pm", "Jan 2024", "31-Dec-99", "x"],
     [at(2024, 1, 15), at(2024, 2, 1), at(2024, 1, 2, 15, 4), at(2024, 1, 1), at(1999, 12, 31), None]),
    (["Monday, January 15, 2024", "Tuesday, May 7, 2024", "January 15, 2024", "Mon, January 15, 2024"],
     [at(2024, 1, 15), at(2024, 5, 7), None, None]),
    (["May 15, 2024", "January 3, 2024"], [at(2024, 5, 15), at(2024, 1, 3)]),
    (["Mon, 15 Jan 2024 08:00", "Tue, 16 Jan 2024 09:30"], [at(2024, 1, 15, 8), at(2024, 1, 16, 9, 30)]),
    (["2024-01-15T10:30:00.123456789Z", "2024-01-16T10:30:00Z", "2024-01-16T10:30:00.5Z"],
     [at(2024, 1, 15, 10, 30, 0, 123456), None, at(2024, 1, 16, 10, 30, 0, 500000)]),
    (["20240115", "20240230", "2024-01-15"], [at(2024, 1, 15), None, None]),
    (["JAN 15, 2024", "January 16, 2024", "2024-01-17"], [at(2024, 1, 15), at(2024, 1, 16), at(2024, 1, 17)]),
])
def test_dates_follow_the_first_value(spark, texts, parsed):
    first = spark.createDataFrame([(texts[0],)], "v string")
    fmt = first.select(dates.date_format("v")).first()[0]
    assert mapped(spark, texts, lambda c: dates.parse_dates(c, F.lit(fmt), [fmt])) == parsed


def test_first_digits(spark):
    texts = ["https://x/jobs/10001?p=2", "nope", None, "https://app2.x/jobs/10", "a١٢/34", "x" + "9" * 20]
    assert mapped(spark, texts, keys.first_digits) == [10001, None, None, 2, None, None]
    numbers = [12.5, 1e5, -5.5, 0.5, 1.5e16, float("inf"), None, 0.0]
    assert mapped(spark, numbers, keys.first_digits_of_number, "double") == [
        12, 100000, 5, 0, 1, None, None, 0]


def test_key_overwrites_and_is_null_without_a_url(spark):
    frame = spark.createDataFrame([(5, "x/7")], "job_id bigint, link string")
    assert keys.with_key(frame, "link").select("job_id").first()[0] == 7
    assert keys.with_key(frame, None).select("job_id").first()[0] is None
