"""The registered queries, each beside the SQL that must give the same rows.

Inputs are the given tables with gaps, odd spellings, summary rows and repeats written
into them by expressions both engines understand.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import names as N
from millrace.functions.keys import with_key
from millrace.functions.values import NULL_TOKENS, nullify
from millrace.operators import coerce, describe, fills, merge, profile, reports, rows
from millrace.plans import lineage
from millrace.plans.clean import Batch, CleanOptions, clean_files, clean_staged, clean_table, fill_counts
from millrace.plans.master import Master, build_master
from millrace.plans.rules import RULES
from millrace.session import run_dir
from millrace.sinks.table import TableTarget, load_table
from millrace.sources import drift, schema
from millrace.sources.assess import assess_files, assess_lines
from millrace.sources.csv_files import stage_csv
from millrace.streaming.incremental import clean_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def messy(spark: SparkSession, folder: str, name: str, columns: dict[str, str]) -> DataFrame:
    return table(spark, folder, name).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def select(name: str, columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {name}"


def gap(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN NULL ELSE {value} END"


# --- keys -------------------------------------------------------------------------------

KEY_SQL = r"TRY_CAST(nullif(regexp_extract(url, '(\p{Nd}+)', 1), '') AS BIGINT)"


@query(f"SELECT page_id, {KEY_SQL} AS job_id FROM pages")
def job_id_from_url(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    url = N.find_url_column(pages.columns)
    return with_key(pages, url).drop(*N.key_source_columns(pages.columns, url))


@query("SELECT o_orderkey, CAST(NULL AS BIGINT) AS job_id FROM orders")
def job_id_without_url(spark: SparkSession, folder: str) -> DataFrame:
    orders = messy(spark, folder, "orders", {"o_orderkey": "o_orderkey", "job_id": "o_custkey"})
    return with_key(orders, N.find_url_column(orders.columns))


@query(f"""
SELECT host, count(*) AS rows, count(job_id) AS keys, count(DISTINCT job_id) AS distinct_keys
FROM (SELECT regexp_extract(url, '://([^/]+)', 1) AS host, {KEY_SQL} AS job_id FROM pages)
GROUP BY host""")
def key_stats(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        "url", F.regexp_extract("url", "://([^/]+)", 1).alias("host"))
    return profile.key_stats(with_key(pages, "url"), by=["host"])


# --- missing values -----------------------------------------------------------------------

CUSTOMER_GAPS = {
    "c_custkey": "c_custkey",
    "c_name": gap("c_custkey % 3 = 0", "c_name"),
    "c_nationkey": gap("c_custkey % 40 = 0", "c_nationkey"),
    "c_acctbal": gap("c_custkey % 7 = 0", "c_acctbal"),
    "c_mktsegment": gap("c_custkey % 5 = 0", "c_mktsegment"),
}


def unpivoted_nulls(name: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (({e}) IS NULL) AS nulls, count(*) AS n FROM {name}"
        for c, e in columns.items()
    )


@query(f"""
SELECT "column", nulls, rint_percent AS missing_percent FROM (
  SELECT *, round_even(nulls * 100 / n, 2) AS rint_percent
  FROM ({unpivoted_nulls("customer", CUSTOMER_GAPS)}))""")
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    customer = messy(spark, folder, "customer", CUSTOMER_GAPS)
    return profile.null_profile(customer, customer.columns)


ORDERS_SPARSE = {
    "o_custkey": gap("o_orderkey % 20 <> 0", "o_custkey"),
    "o_orderstatus": gap("o_orderkey % 10 <> 0", "o_orderstatus"),
    "o_totalprice": gap("o_orderkey % 2 = 0", "o_totalprice"),
    "o_orderpriority": "o_orderpriority",
    "job_id": gap("o_orderkey % 50 <> 0", "o_orderkey"),
}


@query(f"""
SELECT "column", round_even(nulls * 100 / n, 2) AS missing_percent,
  CASE WHEN "column" = 'job_id' THEN 'keep' WHEN nulls * 10 > n * 9 THEN 'drop'
       WHEN nulls > 0 THEN 'fill' ELSE 'keep' END AS decision
FROM ({unpivoted_nulls("orders", ORDERS_SPARSE)})""")
def sparse_column_decision(spark: SparkSession, folder: str) -> DataFrame:
    orders = messy(spark, folder, "orders", ORDERS_SPARSE)
    return profile.sparse_columns(orders, orders.columns)


TOKEN_CASES = " ".join(f"WHEN c_custkey % 25 = {i} THEN '{t}'" for i, t in enumerate(NULL_TOKENS))
TOKENS = {
    "c_custkey": "c_custkey",
    "v": f"CASE {TOKEN_CASES} WHEN c_custkey % 25 = 20 THEN 'none' WHEN c_custkey % 25 = 21 THEN ' ' "
         "WHEN c_custkey % 25 = 22 THEN 'Null' ELSE c_name END",
}


@query(f"""
SELECT c_custkey, CASE WHEN v IN ({", ".join(f"'{t}'" for t in NULL_TOKENS)}) THEN NULL ELSE v END AS v
FROM ({select("customer", TOKENS)})""")
def null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return messy(spark, folder, "customer", TOKENS).select("c_custkey", nullify("v").alias("v"))


# --- summary rows -------------------------------------------------------------------------

EVENT_LABELS = {
    "event_id": "event_id",
    "label": "CASE event_id % 50 WHEN 0 THEN 'Subtotal' WHEN 1 THEN 'Account total' "
             "WHEN 2 THEN 'AVERAGE count' WHEN 3 THEN 'Account' ELSE event_type END",
    "props": "CASE WHEN event_id % 70 = 0 THEN 'Grand Total' ELSE props END",
}
SUMMARY_SCORE = " + ".join(
    f"CAST(contains(lower(concat_ws(' ', CAST(event_id AS VARCHAR), label, props)), '{w}') AS INT)"
    for w in rows.SUMMARY_WORDS
)


@query(f"SELECT * FROM ({select('events', EVENT_LABELS)}) WHERE {SUMMARY_SCORE} < 2")
def summary_row_filter(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_summary_rows(messy(spark, folder, "events", EVENT_LABELS))


@query(f"""
SELECT count(*) AS rows, count(*) FILTER ({SUMMARY_SCORE} >= 2) AS summary_rows
FROM ({select('events', EVENT_LABELS)})""")
def summary_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return rows.summary_row_counts(messy(spark, folder, "events", EVENT_LABELS))


# --- fills ----------------------------------------------------------------------------------


def mode_sql(source: str, value: str, by: str = "") -> str:
    """Rows (by, mode) of a relation, smallest value on ties."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return (
        f"SELECT {keys}{value} AS mode FROM (SELECT {keys}{value}, count(*) AS n FROM {source} "
        f"WHERE {value} IS NOT NULL GROUP BY {keys}{value}) "
        f"QUALIFY row_number() OVER ({part}ORDER BY n DESC, {value}) = 1"
    )


@query(f"""
WITH t AS ({select("customer", CUSTOMER_GAPS)})
SELECT c_custkey, coalesce(c_acctbal, (SELECT median(c_acctbal) FROM t)) AS c_acctbal FROM t""")
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    customer = messy(spark, folder, "customer", CUSTOMER_GAPS).select("c_custkey", "c_acctbal")
    return fills.fill_missing(customer, medians=["c_acctbal"])


@query(f"""
WITH t AS ({select("customer", CUSTOMER_GAPS)})
SELECT c_custkey, coalesce(c_mktsegment, ({mode_sql("t", "c_mktsegment")})) AS c_mktsegment FROM t""")
def impute_mode(spark: SparkSession, folder: str) -> DataFrame:
    customer = messy(spark, folder, "customer", CUSTOMER_GAPS).select("c_custkey", "c_mktsegment")
    return fills.fill_missing(customer, modes=["c_mktsegment"])


LINES_GAPS = {
    "l_returnflag": "l_returnflag",
    "l_orderkey": "l_orderkey",
    "quantity": gap("(l_orderkey + l_linenumber) % 7 = 0", "l_quantity"),
    "price": gap("l_partkey % 9 = 0", "l_extendedprice"),
    "supplier": gap("l_partkey % 6 = 0", "concat('S', CAST(l_suppkey % 97 AS {text}))"),
}
LINES_SPARK = {c: e.format(text="STRING") for c, e in LINES_GAPS.items()}
LINES_SQL = select("lineitem", {c: e.format(text="VARCHAR") for c, e in LINES_GAPS.items()})


@query(f"""
WITH t AS ({LINES_SQL}),
  m AS (SELECT l_returnflag, median(quantity) AS q, median(price) AS p FROM t GROUP BY l_returnflag),
  s AS ({mode_sql("t", "supplier", "l_returnflag")})
SELECT t.l_returnflag, l_orderkey, coalesce(quantity, q) AS quantity, coalesce(price, p) AS price,
  coalesce(supplier, mode) AS supplier
FROM t JOIN m USING (l_returnflag) JOIN s USING (l_returnflag)""")
def impute_per_source(spark: SparkSession, folder: str) -> DataFrame:
    lines = messy(spark, folder, "lineitem", LINES_SPARK)
    return fills.fill_missing(lines, ["quantity", "price"], ["supplier"], ["l_returnflag"])


@query(f"""
WITH t AS ({LINES_SQL})
SELECT l_returnflag, 'quantity' AS "column", median(quantity) AS median FROM t GROUP BY l_returnflag
UNION ALL
SELECT l_returnflag, 'price' AS "column", median(price) AS median FROM t GROUP BY l_returnflag""")
def median_per_source(spark: SparkSession, folder: str) -> DataFrame:
    """Always the bracketed form, whatever the size of the groups."""
    lines = messy(spark, folder, "lineitem", LINES_SPARK)
    values = {c: F.col(c) for c in ("quantity", "price")}
    return fills.bracketed_medians(lines, values, ["l_returnflag"], lines.count())


@query(f"""
WITH t AS ({LINES_SQL})
SELECT l_returnflag, 'supplier' AS "column", mode FROM ({mode_sql("t", "supplier", "l_returnflag")})""")
def mode_per_source(spark: SparkSession, folder: str) -> DataFrame:
    lines = messy(spark, folder, "lineitem", LINES_SPARK)
    return fills.exact_modes(lines, {"supplier": F.col("supplier")}, ["l_returnflag"])


# --- data profiles -----------------------------------------------------------------------------

PROFILED = ("quantity", "price", "supplier")
PROFILE_ORDER = [
    "l_returnflag", "column", "rows", "nulls", "distinct", "least", "most", "least_text", "most_text",
    "q1", "median", "q3", "low_fence", "high_fence", "outliers", "top_value", "top_times",
]


def profile_sql(c: str, number: bool) -> str:
    """The profile of one column of `t`, per l_returnflag."""
    text = f"CAST({c} AS VARCHAR)"
    cuts = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = [f"quantile_cont(CAST({c} AS DOUBLE), {x}) AS {n}" if number else f"CAST(NULL AS DOUBLE) AS {n}" for n, x in cuts.items()]
    ends = [
        f"{f}(CAST({c} AS DOUBLE)) AS {n}, CAST(NULL AS VARCHAR) AS {n}_text" if number else f"CAST(NULL AS DOUBLE) AS {n}, {f}({text}) AS {n}_text"
        for f, n in (("min", "least"), ("max", "most"))
    ]
    far = "count(*) FILTER (CAST(t.{c} AS DOUBLE) < f.low_fence OR CAST(t.{c} AS DOUBLE) > f.high_fence)".format(c=c)
    return f"""
  SELECT f.*, o.outliers, top_value, top_times FROM (
    SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS low_fence, q3 + 1.5::DOUBLE * (q3 - q1) AS high_fence FROM (
      SELECT l_returnflag, '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct",
        {", ".join(ends + quartiles)} FROM t GROUP BY l_returnflag)) f
  JOIN (SELECT t.l_returnflag, {far if number else "CAST(NULL AS BIGINT)"} AS outliers FROM t JOIN (
      SELECT l_returnflag, q1 - 1.5::DOUBLE * (q3 - q1) AS low_fence, q3 + 1.5::DOUBLE * (q3 - q1) AS high_fence FROM (
        SELECT l_returnflag, {", ".join(quartiles)} FROM t GROUP BY l_returnflag)) f USING (l_returnflag) GROUP BY t.l_returnflag) o USING (l_returnflag)
  JOIN (SELECT l_returnflag, {text} AS top_value, count(*) AS top_times FROM t WHERE {c} IS NOT NULL GROUP BY l_returnflag, {text}
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, {text}) = 1) USING (l_returnflag)"""


@query(f"""
WITH t AS ({LINES_SQL})
SELECT {", ".join(f'"{c}"' for c in PROFILE_ORDER)} FROM ({" UNION ALL BY NAME ".join(profile_sql(c, c != "supplier") for c in PROFILED)})""")
def data_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, distinct values, extremes, quartiles, values beyond the fences, per source and column."""
    lines = messy(spark, folder, "lineitem", LINES_SPARK)
    return describe.describe(lines, PROFILED, ["l_returnflag"])


@query(f"""
WITH t AS ({LINES_SQL})
SELECT l_returnflag, 'quantity' AS "column", count(*) AS rows, count(*) - count(quantity) AS nulls, min(quantity)::DOUBLE AS least, max(quantity)::DOUBLE AS most,
  CAST(NULL AS VARCHAR) AS least_text, CAST(NULL AS VARCHAR) AS most_text, true AS distinct_near, true AS quartiles_near FROM t GROUP BY l_returnflag
UNION ALL SELECT l_returnflag, 'price', count(*), count(*) - count(price), min(price), max(price), NULL, NULL, true, true FROM t GROUP BY l_returnflag
UNION ALL SELECT l_returnflag, 'supplier', count(*), count(*) - count(supplier), NULL, NULL, min(supplier), max(supplier), true, true FROM t GROUP BY l_returnflag""")
def data_profile_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of seven batches merged; their estimates against the exact profile of all rows."""
    lines = messy(spark, folder, "lineitem", LINES_SPARK).withColumn("batch", F.pmod("l_orderkey", F.lit(7)))
    kept = describe.sketches(lines, PROFILED, ["l_returnflag", "batch"])
    whole = describe.merged(kept, ["l_returnflag"])
    keys = ["l_returnflag", "column"]
    exact = describe.describe(lines, PROFILED, ["l_returnflag"], whole).select(
        *keys, *[F.col(c).alias(f"exact_{c}") for c in ("distinct", "q1", "median", "q3", "least", "most")])
    found = describe.estimates(whole).join(exact, keys)
    # A share of the rows either way is a share of the range here: the values are spread evenly.
    near = F.lit(True)
    for c in ("q1", "median", "q3"):
        near = near & F.coalesce(F.abs(F.col(c) - F.col(f"exact_{c}")) <= 0.05 * (F.col("exact_most") - F.col("exact_least")), F.lit(True))
    distinct = F.abs(F.col("distinct") - F.col("exact_distinct")) <= 0.08 * F.col("exact_distinct")
    return found.select(*keys, "rows", "nulls", "least", "most", "least_text", "most_text", distinct.alias("distinct_near"), near.alias("quartiles_near"))


# --- types ----------------------------------------------------------------------------------

PART_TEXT = {
    "p_partkey": "p_partkey",
    "p_brand": "p_brand",
    "size_text": "CASE WHEN p_partkey % 10 = 0 THEN 'n/a kg' WHEN p_partkey % 11 = 0 THEN "
                 "concat(CAST(p_size AS {text}), 'd') WHEN p_partkey % 12 = 0 THEN '12.' "
                 "WHEN p_partkey % 13 = 0 THEN ' 7 ' ELSE CAST(p_size AS {text}) END",
    "code": "CAST(p_partkey AS {text})",
}
PART_SPARK = {c: e.format(text="STRING") for c, e in PART_TEXT.items()}
PART_SQL = select("part", {c: e.format(text="VARCHAR") for c, e in PART_TEXT.items()})


@query(f"""
SELECT p_partkey, p_brand, CAST(code AS BIGINT) AS code,
  CASE WHEN regexp_matches(size_text, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')
       THEN TRY_CAST(trim(size_text) AS DOUBLE) END AS size_text
FROM ({PART_SQL})""")
def numeric_coercion(spark: SparkSession, folder: str) -> DataFrame:
    part = messy(spark, folder, "part", PART_SPARK)
    return coerce.coerce_numbers(part, ["p_brand", "size_text", "code"])


ORDER_DATES = {
    "o_orderkey": "o_orderkey",
    "order_date": "CASE WHEN o_orderkey % 14 = 13 THEN '01/02/2024' WHEN o_orderkey % 17 = 16 "
                  "THEN '2024-02-30' WHEN o_orderkey % 19 = 18 THEN '2024-01-10 10:00' "
                  "ELSE substr(CAST(o_orderdate AS {text}), 1, 10) END",
    "updated_time": "substr(CAST(o_orderdate AS {text}), 1, 19)",
}
DATES_SPARK = {c: e.format(text="STRING") for c, e in ORDER_DATES.items()}
DATES_SQL = select("orders", {c: e.format(text="VARCHAR") for c, e in ORDER_DATES.items()})


@query(f"""
SELECT o_orderkey, try_strptime(order_date, '%Y-%m-%d') AS order_date,
  try_strptime(updated_time, '%Y-%m-%d %H:%M:%S') AS updated_time
FROM ({DATES_SQL})""")
def datetime_coercion(spark: SparkSession, folder: str) -> DataFrame:
    return coerce.coerce_dates(messy(spark, folder, "orders", DATES_SPARK), ["o_orderkey"])


SPELLINGS = {
    "date_us": ("M/d/yyyy h:mm:ss a", "t"),
    "date_us_tight": ("MM/dd/yyyy hh:mma", "date_trunc('minute', t)"),
    "date_short": ("dd-MMM-yy", "d"),
    "date_short_clock": ("M/d/yy h:mm a", "date_trunc('minute', t)"),
    "date_week": ("EEEE, MMMM d, yyyy", "d"),
    "date_week_short": ("EEE, d MMM yyyy HH:mm:ss", "t"),
    "date_nano": ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'789Z'", "t"),
    "date_words": ("MMMM d yyyy h:mm:ss a", "t"),
    "date_tight": ("yyyyMMdd HH:mm", "date_trunc('minute', t)"),
}


@query(f"""
SELECT o_orderkey, {', '.join(f"CASE WHEN o_orderkey % 14 <> 13 THEN CAST({e} AS TIMESTAMP) END AS {c}" for c, (_, e) in SPELLINGS.items())}
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS t FROM orders)""")
def datetime_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """One column per spelling of a date that exports use; every 14th cell is in another one."""
    time = "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, o_orderkey % 86400)"
    cells = {c: f'CASE WHEN o_orderkey % 14 = 13 THEN \'week 3\' ELSE date_format({time}, "{f}") END' for c, (f, _) in SPELLINGS.items()}
    return coerce.coerce_dates(messy(spark, folder, "orders", {"o_orderkey": "o_orderkey", **cells}), ["o_orderkey"])


NAN = "CASE WHEN l_linenumber % 5 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_linenumber % 7 = 0 THEN NULL ELSE l_discount END"


@query(f"""
WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN isnan(d) THEN NULL ELSE d END AS d
           FROM (SELECT l_orderkey, l_linenumber, {NAN} AS d FROM lineitem))
SELECT l_orderkey, l_linenumber, coalesce(d, (SELECT median(d) FROM t)) AS d,
  (SELECT count(*) FROM t WHERE d IS NULL) AS nulls FROM t""")
def nan_is_missing(spark: SparkSession, folder: str) -> DataFrame:
    """NaN counts as missing, has no part in the median, and is filled with it."""
    lines = messy(spark, folder, "lineitem", {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "d": NAN})
    missing = profile.null_profile(lines, ["d"]).first()["nulls"]
    return fills.fill_missing(lines, medians=["d"]).withColumn("nulls", F.lit(missing))


# --- duplicates -------------------------------------------------------------------------------


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount, l_suppkey FROM lineitem")
def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return rows.drop_duplicate_rows(
        lines.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_suppkey"))


@query(f"""
WITH t AS ({select("customer", CUSTOMER_GAPS)})
SELECT DISTINCT c_nationkey, coalesce(c_mktsegment, ({mode_sql("t", "c_mktsegment")})) AS c_mktsegment
FROM t""")
def dedup_after_fill(spark: SparkSession, folder: str) -> DataFrame:
    customer = messy(spark, folder, "customer", CUSTOMER_GAPS).select("c_nationkey", "c_mktsegment")
    return rows.drop_duplicate_rows(fills.fill_missing(customer, modes=["c_mktsegment"]))


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return rows.preview(table(spark, folder, "orders"), ["o_orderkey"])


# --- merges -------------------------------------------------------------------------------------

CUSTOMER_FILE = {
    "job_id": gap("c_custkey = 1", "c_custkey"), "name": "c_name", "balance": "c_acctbal",
    "source_file": "'customer.csv'",
}
ORDERS_FILE = {
    "job_id": gap("o_custkey = 1", "o_custkey"), "order_id": "o_orderkey", "balance": "o_totalprice",
    "source_file": "'orders.csv'",
}
SUPPLIER_FILE = {
    "job_id": "s_suppkey", "name": "s_name", "supplier_nation": "s_nationkey",
    "source_file": "'supplier.csv'",
}
PART_FILE = {
    "job_id": "p_partkey", "name": "p_name", "size": "p_size", "source_file": "'part.csv'",
}
C, O, S, P = (
    f"({select(name, columns)})"
    for name, columns in (("customer", CUSTOMER_FILE), ("orders", ORDERS_FILE),
                          ("supplier", SUPPLIER_FILE), ("part", PART_FILE))
)
FILES = {"customer": CUSTOMER_FILE, "orders": ORDERS_FILE, "supplier": SUPPLIER_FILE, "part": PART_FILE}


def files(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [messy(spark, folder, n, FILES[n]) for n in names]


SAME_KEY = "ON a.job_id IS NOT DISTINCT FROM b.job_id"
OUTER_SQL = f"""SELECT CASE WHEN a.source_file IS NULL THEN b.job_id ELSE a.job_id END AS job_id,
  a.name, a.balance, a.source_file, b.order_id FROM {C} a FULL JOIN {O} b {SAME_KEY}"""


@query(OUTER_SQL)
def merge_outer(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge_frames(files(spark, folder, "customer", "orders"), "outer")


@query(f"""SELECT a.job_id, a.name, a.balance, a.source_file, b.order_id
FROM {C} a JOIN {O} b {SAME_KEY}""")
def merge_inner(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge_frames(files(spark, folder, "customer", "orders"), "inner")


@query(f"""
WITH m AS ({OUTER_SQL.replace(", b.order_id", ", b.order_id, true AS in_m")})
SELECT CASE WHEN in_m THEN a.job_id ELSE b.job_id END AS job_id, a.name, a.balance, a.source_file,
  a.order_id, b.supplier_nation
FROM m a FULL JOIN {S} b {SAME_KEY}""")
def merge_outer_3way(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge_frames(files(spark, folder, "customer", "orders", "supplier"), "outer")


@query(f"""
WITH m AS (SELECT coalesce(a.job_id, b.job_id) AS job_id, a.name, a.source_file, a.supplier_nation, b.size
           FROM {S} a FULL JOIN {P} b ON a.job_id = b.job_id)
SELECT coalesce(m.job_id, c.job_id) AS job_id, m.name, m.supplier_nation, m.source_file, m.size, c.balance
FROM m FULL JOIN (SELECT c_custkey AS job_id, c_acctbal AS balance FROM customer) c
  ON m.job_id = c.job_id""")
def merge_outer_groupby(spark: SparkSession, folder: str) -> DataFrame:
    """Unique keys in every file: the three-way fold is one aggregation."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("job_id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"))
    return merge.merge_frames([*files(spark, folder, "supplier", "part"), customer], "outer")


@query(f"""
SELECT s.job_id, s.name, s.supplier_nation, s.source_file, p.size, c.c_acctbal AS balance
FROM {S} s JOIN {P} p ON s.job_id = p.job_id JOIN customer c ON c.c_custkey = s.job_id""")
def merge_inner_groupby(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("job_id"), F.col("c_acctbal").alias("balance"))
    return merge.merge_frames([*files(spark, folder, "supplier", "part"), customer], "inner")


HOT_ORDERS = ORDERS_FILE | {"job_id": "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END"}


@query(f"""SELECT CASE WHEN a.source_file IS NULL THEN b.job_id ELSE a.job_id END AS job_id,
  a.name, a.balance, a.source_file, b.order_id
FROM {C} a FULL JOIN ({select("orders", HOT_ORDERS)}) b {SAME_KEY}""")
def merge_outer_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all orders share one key, whose rows are spread over many join keys."""
    orders = messy(spark, folder, "orders", HOT_ORDERS)
    return merge.merge_frames([*files(spark, folder, "customer"), orders], "outer", skew=merge.Skew(task_rows=200))


BOTH_HEAVY = [
    CUSTOMER_FILE | {"job_id": "CASE WHEN c_custkey % 20 = 0 THEN {key} ELSE c_custkey END"},
    ORDERS_FILE | {"job_id": "CASE WHEN o_orderkey % 50 = 0 THEN {key} ELSE o_custkey END"},
]


def both_heavy(key: str) -> list[dict[str, str]]:
    return [{c: e.format(key=key) if c == "job_id" else e for c, e in f.items()} for f in BOTH_HEAVY]


def heavy_sql(key: str) -> str:
    left, right = (select(n, f) for n, f in zip(("customer", "orders"), both_heavy(key)))
    return f"""SELECT CASE WHEN a.source_file IS NULL THEN b.job_id ELSE a.job_id END AS job_id,
  a.name, a.balance, a.source_file, b.order_id FROM ({left}) a FULL JOIN ({right}) b {SAME_KEY}"""


def heavy_merge(spark: SparkSession, folder: str, key: str) -> DataFrame:
    frames = [messy(spark, folder, n, f) for n, f in zip(("customer", "orders"), both_heavy(key))]
    return merge.merge_frames(frames, "outer", skew=merge.Skew(task_rows=500))


@query(heavy_sql("7"))
def merge_outer_hot_both(spark: SparkSession, folder: str) -> DataFrame:
    """One key is heavy on both sides: its rows are dealt to a grid of join keys."""
    return heavy_merge(spark, folder, "7")


@query(heavy_sql("NULL"))
def merge_outer_null_heavy(spark: SparkSession, folder: str) -> DataFrame:
    """Null keys are many on both sides, and all of them match."""
    return heavy_merge(spark, folder, "NULL")


@query(f"""
WITH m AS (SELECT CASE WHEN a.source_file IS NULL THEN b.job_id ELSE a.job_id END AS job_id,
             a.name, a.balance, a.source_file
           FROM {C} a FULL JOIN (SELECT s_suppkey * 40 AS job_id FROM supplier) b {SAME_KEY})
SELECT CASE WHEN a.source_file IS NULL AND a.job_id IS NULL THEN b.job_id ELSE a.job_id END AS job_id,
  a.name, a.balance, a.source_file
FROM m a FULL JOIN (SELECT s_nationkey * 2 AS job_id FROM supplier) b {SAME_KEY}""")
def merge_outer_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Files that bring no columns only repeat rows and add keys."""
    others = [
        messy(spark, folder, "supplier", {"job_id": f"CAST({key} AS BIGINT)", "name": "s_name"})
        for key in ("s_suppkey * 40", "s_nationkey * 2")
    ]
    return merge.merge_frames([*files(spark, folder, "customer"), *others], "outer")


CONCAT_ORDERS = {"job_id": "o_custkey", "amount": "o_totalprice", "code": "o_orderstatus", "source_file": "'orders.csv'"}
CONCAT_CUSTOMER = {"job_id": "c_custkey", "amount": "c_nationkey", "code": "c_nationkey",
                   "segment": "c_mktsegment", "source_file": "'customer.csv'"}
CONCAT_SQL = f"""
SELECT job_id, CAST(amount AS DOUBLE) AS amount, code, source_file, NULL AS segment
FROM ({select("orders", CONCAT_ORDERS)})
UNION ALL
SELECT job_id, CAST(amount AS DOUBLE), CAST(code AS VARCHAR), source_file, segment
FROM ({select("customer", CONCAT_CUSTOMER)})"""


def stacked(spark: SparkSession, folder: str) -> DataFrame:
    return merge.stack_frames([
        messy(spark, folder, "orders", CONCAT_ORDERS),
        messy(spark, folder, "customer", CONCAT_CUSTOMER),
    ])


@query(CONCAT_SQL)
def concat_files(spark: SparkSession, folder: str) -> DataFrame:
    return stacked(spark, folder)


# --- reports ------------------------------------------------------------------------------------


@query(f"SELECT source_file, count(*) AS records FROM ({CONCAT_SQL}) GROUP BY source_file")
def records_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return reports.records_per_source(stacked(spark, folder))


OUTER_COLUMNS = ["job_id", "name", "balance", "source_file", "order_id"]
ALERT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls, count(*) AS n FROM m"
    for c in OUTER_COLUMNS
)

def gappy(spark: SparkSession, folder: str) -> DataFrame:
    """An outer merge in which most keys are on one side only."""
    customer = CUSTOMER_FILE | {"job_id": gap("c_custkey = 1", "c_custkey * 2")}
    return merge.merge_frames([messy(spark, folder, "customer", customer), *files(spark, folder, "orders")])


@query(f"""
WITH m AS (SELECT CASE WHEN a.source_file IS NULL THEN b.job_id ELSE a.job_id * 2 END AS job_id,
  a.name, a.balance, a.source_file, b.order_id
  FROM {C} a FULL JOIN {O} b ON a.job_id * 2 IS NOT DISTINCT FROM b.job_id)
SELECT "column", nulls FROM ({ALERT_SQL}) WHERE nulls * 10 > n""")
def missing_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_alerts(gappy(spark, folder))


@query(f"""
SELECT count(*) AS total_rows, 5 AS total_columns, count(DISTINCT job_id) AS unique_keys,
  count(DISTINCT source_file) AS source_files FROM ({OUTER_SQL})""")
def master_overview(spark: SparkSession, folder: str) -> DataFrame:
    return reports.overview(merge_outer(spark, folder))


@query(f"""
WITH m AS ({CONCAT_SQL})
SELECT 'Dataset Overview' AS section, 'Total Rows' AS metric, format('{{:,}}', count(*)) AS value FROM m
UNION ALL SELECT 'Dataset Overview', 'Total Columns', '5'
UNION ALL SELECT 'Dataset Overview', 'Unique Job IDs', format('{{:,}}', count(DISTINCT job_id)) FROM m
UNION ALL SELECT 'Dataset Overview', 'Source Files', CAST(count(DISTINCT source_file) AS VARCHAR) FROM m
UNION ALL SELECT 'Records per Source File', source_file, CAST(count(*) AS VARCHAR) FROM m GROUP BY source_file
UNION ALL SELECT 'Data Quality Alerts', 'segment', CAST(count(*) FILTER (segment IS NULL) AS VARCHAR) FROM m
  HAVING count(*) FILTER (segment IS NULL) * 10 > count(*)""")
def master_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.master_report(stacked(spark, folder))


# --- the whole cleaning plan ----------------------------------------------------------------------

# Orders as three exports by status, with every kind of mess: links for keys, gaps of all
# sizes, summary rows, numbers among text, dates in two formats, repeated rows.
EXPORT = {
    "Order Link": gap("o_orderkey % 101 = 0 AND o_orderstatus = 'F'", "concat('https://shop.example/orders/', CAST(CAST((o_orderkey - o_orderkey % 3) / 3 AS BIGINT) AS {text}))"),
    " Total  Price!": gap("o_orderkey % 8 = 0", "o_totalprice"),
    "Clerk/Note": "CASE WHEN o_orderkey % 40 = 0 THEN 'Subtotal' WHEN o_orderkey % 41 = 0 THEN "
                  "'Account total' ELSE concat('note ', CAST(o_custkey % 5 AS {text})) END",
    "Ship Code": "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN "
                 "concat('x', CAST(o_custkey % 50 AS {text})) ELSE CAST(o_custkey % 50 AS {text}) END",
    "Order Date": "CASE WHEN o_orderkey % 15 = 0 THEN NULL WHEN o_orderkey % 14 = 13 THEN '01/02/2024' "
                  "ELSE substr(CAST(o_orderdate AS {text}), 1, 10) END",
    "Rare": gap("o_orderkey % 25 <> 0", "o_orderpriority"),
    "Unnamed: 6": "o_orderpriority",
    "file": "concat(o_orderstatus, '.csv')",
    "row": "o_orderkey * 2 + copy",
}
EXPORT_SPARK = {c: e.format(text="STRING") for c, e in EXPORT.items()}
EXPORT_SQL_COLUMNS = {c: e.format(text="VARCHAR") for c, e in EXPORT.items()}
COPIES = "CASE WHEN o_orderkey % 50 = 3 THEN {two} ELSE {one} END"
COPIED = f"(SELECT *, unnest({COPIES.format(two='[0, 1]', one='[0]')}) AS copy FROM orders)"
EXPORT_SQL = f"""
exported AS ({select(COPIED, EXPORT_SQL_COLUMNS)}),
raw AS (SELECT "Order Link" AS url, " Total  Price!" AS price, "Clerk/Note" AS note, "Ship Code" AS code,
  "Order Date" AS day, "Rare" AS rare, "Unnamed: 6" AS blank, file, "row" FROM exported),
kept AS (SELECT * FROM raw WHERE {" + ".join(
    f"CAST(contains(lower(concat_ws(' ', url, note, code, day, rare, blank)), '{w}') AS INT)"
    for w in rows.SUMMARY_WORDS)} < 2),
medians AS (SELECT file, median(price) AS price_fill FROM kept GROUP BY file),
codes AS (SELECT file, mode AS code_fill FROM ({mode_sql("kept", "code", "file")})),
days AS (SELECT file, mode AS day_fill FROM ({mode_sql("kept", "day", "file")})),
firsts AS (SELECT file, coalesce(day, day_fill) AS first_day FROM kept JOIN days USING (file)
  QUALIFY row_number() OVER (PARTITION BY file ORDER BY "row") = 1),
cleaned AS (
  SELECT DISTINCT
    coalesce(price, price_fill) AS total_price, note AS clerk_note,
    CASE WHEN regexp_matches(coalesce(code, code_fill), '^[0-9]+$')
         THEN CAST(coalesce(code, code_fill) AS DOUBLE) END AS ship_code,
    CASE WHEN first_day LIKE '%/%' THEN try_strptime(coalesce(day, day_fill), '%m/%d/%Y')
         ELSE try_strptime(coalesce(day, day_fill), '%Y-%m-%d') END AS order_date,
    TRY_CAST(nullif(regexp_extract(url, '([0-9]+)', 1), '') AS BIGINT) AS job_id,
    file AS source_file
  FROM kept JOIN medians USING (file) JOIN codes USING (file) JOIN days USING (file)
    JOIN firsts USING (file))"""


def exports(spark: SparkSession, folder: str) -> DataFrame:
    copies = F.expr(f"explode({COPIES.format(two='array(0, 1)', one='array(0)')})")
    copied = table(spark, folder, "orders").withColumn("copy", copies)
    return copied.selectExpr(*[f"{e} AS `{c}`" for c, e in EXPORT_SPARK.items()])


def cleaned_exports(spark: SparkSession, folder: str, **options) -> Batch:
    return clean_table(exports(spark, folder), source="file", order="row",
                       options=CleanOptions(**options))


@query(f"WITH {EXPORT_SQL} SELECT * FROM cleaned")
def clean_exports(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned_exports(spark, folder, write_result=False).data


def report_row(position: int, original: str, cleaned: str, value: str | None, action: str, details: str) -> str:
    missing = f"round_even(count(*) FILTER ({value} IS NULL) * 100 / count(*), 2)" if value else "0.0"
    return (f"SELECT raw.file AS source_file, {position} AS position, '{original}' AS original_column, "
            f"CAST({missing} AS DOUBLE) AS missing_percent_before, '{cleaned}' AS cleaned_column, "
            f"'{action}' AS action, {details} AS details FROM raw JOIN medians USING (file) "
            "JOIN codes USING (file) JOIN days USING (file) GROUP BY raw.file")


REPORT_SQL = " UNION ALL ".join(report_row(*line) for line in (
    (0, "Order Link", "order_link", "url", "Dropped", "'Dropped after job_id extraction'"),
    (1, " Total  Price!", "total_price", "price", "Filled",
     "concat('Filled with median (', CAST(max(price_fill) AS VARCHAR), ')')"),
    (2, "Clerk/Note", "clerk_note", "note", "Kept", "''"),
    (3, "Ship Code", "ship_code", "code", "Filled",
     "concat('Filled with mode (''', max(code_fill), ''') | Type changed to numeric')"),
    (4, "Order Date", "order_date", "day", "Filled",
     "concat('Filled with mode (''', max(day_fill), ''') | Type changed to datetime')"),
    (5, "Rare", "rare", "rare", "Dropped", "'Dropped (>90% missing)'"),
    (6, "Unnamed: 6", "unnamed_6", "blank", "Dropped", "'Dropped after job_id extraction'"),
    (7, "job_id", "job_id", None, "Kept", "''"),
))


@query(f"WITH {EXPORT_SQL} {REPORT_SQL}")
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned_exports(spark, folder, write_result=False).report


@query(f"""
WITH {EXPORT_SQL}
SELECT * FROM (
  SELECT file AS source_file, 'total_price' AS "column", 'median' AS fill, count(*) FILTER (price IS NULL) AS filled, CAST(max(price_fill) AS VARCHAR) AS value
  FROM kept JOIN medians USING (file) GROUP BY file
  UNION ALL SELECT file, 'ship_code', 'mode', count(*) FILTER (code IS NULL), max(code_fill) FROM kept JOIN codes USING (file) GROUP BY file
  UNION ALL SELECT file, 'order_date', 'mode', count(*) FILTER (day IS NULL), max(day_fill) FROM kept JOIN days USING (file) GROUP BY file)
WHERE filled > 0""")
def nulls_filled(spark: SparkSession, folder: str) -> DataFrame:
    """How many gaps of each column of each file were filled, and with what."""
    return fill_counts(cleaned_exports(spark, folder, write_result=False))


@query(f"""
WITH {EXPORT_SQL}
SELECT file AS source_file, "row", 'ship_code' AS "column", code AS value, 'not a number' AS reason FROM kept
WHERE code IS NOT NULL AND NOT regexp_matches(code, '^[0-9]+$')
UNION ALL
SELECT file, "row", 'order_date', day, 'not a date in the column''s format' FROM kept JOIN firsts USING (file)
WHERE day IS NOT NULL AND CASE WHEN first_day LIKE '%/%' THEN try_strptime(day, '%m/%d/%Y') ELSE try_strptime(day, '%Y-%m-%d') END IS NULL""")
def values_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Every text that coercion made null, with its place in its file."""
    return cleaned_exports(spark, folder, write_result=False).rejected_values


EXPORT_RULES = [
    ("F%", "summary_word", None, "Subtotal"), ("F%", "sparse_percent", "rare", "97"), ("F%", "rename", "clerk_note", "remark"),
    ("O%", "drop", "ship_code", None), ("O%", "rename", "clerk_note", "remark"), (None, "rename", "rare", "urgency"), ("O%", "sparse_percent", None, "99"),
]


# F.csv: rows with `Subtotal` alone are summary rows; rare columns stay, their gaps filled. O.csv: no ship code.
RULED_SQL = f"""
{EXPORT_SQL.split("kept AS (")[0]}
scored AS (SELECT *, {" + ".join(f"CAST(contains(lower(concat_ws(' ', url, note, code, day, rare, blank)), '{w}') AS INT)" for w in rows.SUMMARY_WORDS)} AS score,
  contains(lower(concat_ws(' ', url, note, code, day, rare, blank)), 'subtotal') AS sub FROM raw),
kept AS (SELECT * FROM scored WHERE CASE WHEN file = 'F.csv' THEN NOT sub ELSE score < 2 END),
rares AS (SELECT file, mode AS rare_fill FROM ({mode_sql("kept", "rare", "file")})),
{"medians AS (" + EXPORT_SQL.split("medians AS (")[1].split("cleaned AS (")[0]}
cleaned AS (
  SELECT DISTINCT
    coalesce(price, price_fill) AS total_price, CASE WHEN file = 'P.csv' THEN note END AS clerk_note, CASE WHEN file <> 'P.csv' THEN note END AS remark,
    CASE WHEN file <> 'O.csv' AND regexp_matches(coalesce(code, code_fill), '^[0-9]+$') THEN CAST(coalesce(code, code_fill) AS DOUBLE) END AS ship_code,
    CASE WHEN first_day LIKE '%/%' THEN try_strptime(coalesce(day, day_fill), '%m/%d/%Y') ELSE try_strptime(coalesce(day, day_fill), '%Y-%m-%d') END AS order_date,
    CASE WHEN file <> 'P.csv' THEN coalesce(rare, rare_fill) END AS urgency,
    TRY_CAST(nullif(regexp_extract(url, '([0-9]+)', 1), '') AS BIGINT) AS job_id, file AS source_file
  FROM kept JOIN medians USING (file) JOIN codes USING (file) JOIN days USING (file) JOIN firsts USING (file) LEFT JOIN rares USING (file))"""


@query(f"WITH {RULED_SQL} SELECT * FROM cleaned")
def clean_by_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Three exports in one plan, two of them under rules of their own."""
    rules = spark.createDataFrame(EXPORT_RULES, RULES)
    return cleaned_exports(spark, folder, write_result=False, rules=rules).data


STATUS_SQL = """
statuses AS (
  SELECT file AS file_name, r.raw_rows, r.raw_rows - k.kept_rows AS summary_rows,
    k.kept_rows - c.cleaned_rows AS duplicate_rows, c.cleaned_rows, c.keys_found, 7 AS n_columns,
    true AS success, CAST(NULL AS VARCHAR) AS error
  FROM (SELECT file, count(*) AS raw_rows FROM raw GROUP BY file) r
  JOIN (SELECT file, count(*) AS kept_rows FROM kept GROUP BY file) k USING (file)
  JOIN (SELECT source_file AS file, count(*) AS cleaned_rows, count(job_id) AS keys_found
        FROM cleaned GROUP BY source_file) c USING (file))"""


@query(f"WITH {EXPORT_SQL}, {STATUS_SQL} SELECT * FROM statuses")
def file_status(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned_exports(spark, folder).status


@query(f"""
WITH {EXPORT_SQL}, {STATUS_SQL}
SELECT count(*) AS files_ok, 0 AS files_failed, sum(cleaned_rows) AS total_rows,
  sum(keys_found) AS total_keys FROM statuses""")
def batch_status(spark: SparkSession, folder: str) -> DataFrame:
    return reports.batch_summary(cleaned_exports(spark, folder).status)


def fold_sql(how: str) -> str:
    """F.csv owns every column; O.csv and P.csv only repeat rows and add keys."""
    one = "(SELECT job_id FROM cleaned WHERE source_file = '{}') b"
    columns = "a.total_price, a.clerk_note, a.ship_code, a.order_date, a.source_file"
    key = "CASE WHEN a.source_file IS NULL AND a.job_id IS NULL THEN b.job_id ELSE a.job_id END AS job_id"
    return f"""first AS (SELECT * FROM cleaned WHERE source_file = 'F.csv'),
second AS (SELECT {key}, {columns} FROM first a {how} JOIN {one.format("O.csv")} {SAME_KEY}),
third AS (SELECT {key}, {columns} FROM second a {how} JOIN {one.format("P.csv")} {SAME_KEY})"""


def master_of(spark: SparkSession, folder: str, how: str) -> Master:
    return build_master(cleaned_exports(spark, folder), how)


@query(f"WITH {EXPORT_SQL}, {fold_sql('FULL')} SELECT * FROM third")
def master_outer(spark: SparkSession, folder: str) -> DataFrame:
    return master_of(spark, folder, "outer").data


CONVERTED_SQL = EXPORT_SQL.split("cleaned AS (")[1].replace("SELECT DISTINCT", 'SELECT "row",', 1).rstrip().removesuffix(")")
MASTER_VALUES = ("total_price", "clerk_note", "ship_code", "order_date", "job_id", "source_file")


@query(f"""
WITH {EXPORT_SQL}, {fold_sql('FULL')}, masters AS (SELECT DISTINCT {", ".join(MASTER_VALUES)} FROM third), converted AS ({CONVERTED_SQL}),
edges AS (
  SELECT m.*, c.source_file AS file, c."row" FROM masters m JOIN converted c ON c.source_file = 'F.csv'
    AND {" AND ".join(f"m.{c} IS NOT DISTINCT FROM c.{c}" for c in MASTER_VALUES)}
  UNION ALL
  SELECT m.*, c.source_file, c."row" FROM masters m JOIN converted c ON c.source_file <> 'F.csv' AND m.job_id IS NOT DISTINCT FROM c.job_id)
SELECT {", ".join(MASTER_VALUES)}, count(DISTINCT file) AS files, count(*) AS input_rows, min("row") AS first_row, max("row") AS last_row
FROM edges GROUP BY ALL""")
def master_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the master dataset with how many files and input rows it comes from."""
    batch = cleaned_exports(spark, folder)
    master = build_master(batch, "outer")
    edges = lineage.lineage(batch, master).groupBy("master_id").agg(
        F.count_distinct("source_file").alias("files"), F.count(F.lit(1)).alias("input_rows"), F.min("row").alias("first_row"), F.max("row").alias("last_row"))
    rows = lineage.with_row_ids(master.data, "master_id").distinct()
    return rows.join(edges, "master_id", "left").drop("master_id")


@query(f"WITH {EXPORT_SQL}, {fold_sql('INNER')} SELECT * FROM third")
def master_inner(spark: SparkSession, folder: str) -> DataFrame:
    return master_of(spark, folder, "inner").data


OWNERS = {
    "customer": ("a.csv", "c_custkey", "c_acctbal", "CAST(NULL AS {text})", "CAST(NULL AS {text})"),
    "orders": ("b.csv", "o_custkey", "CAST(NULL AS DOUBLE)", "o_orderstatus", "CAST(NULL AS {text})"),
    "supplier": ("c.csv", "s_suppkey", "CAST(NULL AS DOUBLE)", "CAST(NULL AS {text})", "s_name"),
}


@query("""
WITH a AS (SELECT DISTINCT CAST(c_custkey AS BIGINT) AS job_id, c_acctbal AS balance FROM customer),
b AS (SELECT DISTINCT CAST(o_custkey AS BIGINT) AS job_id, o_orderstatus AS status FROM orders),
c AS (SELECT DISTINCT CAST(s_suppkey AS BIGINT) AS job_id, s_name AS supplier FROM supplier),
ab AS (SELECT coalesce(a.job_id, b.job_id) AS job_id, balance, status, CASE WHEN a.job_id IS NOT NULL THEN 'a.csv' END AS source_file
       FROM a FULL JOIN b ON a.job_id = b.job_id)
SELECT coalesce(ab.job_id, c.job_id) AS job_id, balance, status, supplier, source_file FROM ab FULL JOIN c ON ab.job_id = c.job_id""")
def master_outer_owners(spark: SparkSession, folder: str) -> DataFrame:
    """Three files, each the only one to have a column, merged from the table of cleaned rows."""
    parts = [
        table(spark, folder, name).selectExpr(
            f"'{file}' AS file", f"concat('https://x/', CAST({key} AS STRING)) AS link",
            *[f"{e.format(text='STRING')} AS {c}" for e, c in zip(cells, ("balance", "status", "supplier"))])
        for name, (file, key, *cells) in OWNERS.items()
    ]
    rows_ = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return build_master(clean_table(rows_, source="file"), "outer").data


@query(f"WITH {EXPORT_SQL} SELECT * FROM cleaned")
def master_concat(spark: SparkSession, folder: str) -> DataFrame:
    return master_of(spark, folder, "concat").data


# --- files and tables -------------------------------------------------------------------------------


def scratch(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def as_csv(spark: SparkSession, frame: DataFrame, label: str) -> str:
    path = scratch(spark, label)
    frame.write.option("header", "true").option("escape", '"').csv(path)
    return path


@query("""
SELECT source, 'utf-8' AS working_encoding, count(*) AS lines,
  max(length(text) - length(replace(text, ',', ''))) AS max_commas
FROM documents GROUP BY source""")
def assess_text(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(
        F.col("source").alias("file_path"), F.lit(0).cast("bigint").alias("_block"),
        F.col("doc_id").alias("_id"), F.col("text").alias("value"))
    return assess_lines(documents).select(
        F.col("file_path").alias("source"), "working_encoding", "lines", "max_commas")


@query("""
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
  CAST(NULL AS BIGINT) AS job_id FROM customer""")
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Customer written as CSV files, then assessed, scanned, typed and cleaned from them."""
    path = as_csv(spark, table(spark, folder, "customer"), "customer-csv")
    return clean_files(spark, path).data.drop("source_file")


@query("""
SELECT 'utf-8' AS working_encoding, ',' AS likely_delimiter, 0 AS issues,
  (SELECT count(*) FROM orders) AS rows, max(5) AS max_commas FROM orders""")
def csv_assessment(spark: SparkSession, folder: str) -> DataFrame:
    path = as_csv(spark, table(spark, folder, "orders"), "orders-csv")
    found = assess_files(spark, path)
    return found.groupBy("working_encoding", "likely_delimiter").agg(
        F.sum(F.size("issues_found")).alias("issues"),
        (F.sum("lines") - F.count(F.lit(1))).alias("rows"),
        F.max("max_commas").alias("max_commas"),
    )


RAGGED = {
    "line": "concat(CAST(o_orderkey AS {text}), ',', o_orderstatus, CASE WHEN o_orderkey % 9 = 0 THEN '' "
            "WHEN o_orderkey % 10 = 0 THEN concat(',', o_orderpriority, ',') "
            "ELSE concat(',', o_orderpriority) END)",
}


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END
  AS o_orderpriority
FROM orders WHERE o_orderkey % 9 = 0 OR o_orderkey % 10 <> 0""")
def csv_ragged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with too many fields are skipped, rows with too few are kept."""
    header = "o_orderkey,o_orderstatus,o_orderpriority"
    lines = messy(spark, folder, "orders", {header: RAGGED["line"].format(text="STRING")})
    path = scratch(spark, "ragged")
    lines.write.option("header", "true").option("quote", "\u0000").option("sep", "\u0001").csv(path)
    staged = stage_csv(spark, path)
    return staged.data.select(
        F.col("c0").cast("bigint").alias("o_orderkey"), F.col("c1").alias("o_orderstatus"),
        F.col("c2").alias("o_orderpriority"))


BREAKS = {
    "doc_id": "doc_id", "text": "CASE WHEN doc_id % 3 = 0 THEN replace(text, '{n}', '{rn}') WHEN doc_id % 7 = 0 "
    "THEN concat('\"', text, '\"\"{n}{r}') ELSE text END", "lang": "lang",
}


def breaks(n: str, r: str) -> dict[str, str]:
    return {c: e.format(n=n, r=r, rn=r + n) for c, e in BREAKS.items()}


@query(select("documents", breaks("\n", "\r")))
def csv_quoted_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks and quotes, under a header with one, in files with CRLF line ends."""
    documents = messy(spark, folder, "documents", breaks("\\n", "\\r"))
    field = lambda c: F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", field("doc_id"), field("text"), field("lang"))
    path = scratch(spark, "breaks")
    # Files of some 16 MB of texts, each with the header as its first record.
    size = documents.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    files = 2 + size // (16 << 20)
    file = F.pmod(F.xxhash64("doc_id"), F.lit(files)).alias("file")
    header = spark.range(files).select(F.lit('"doc\r\nid",text,lang').alias("line"), F.lit(-1).cast("bigint").alias("place"), F.col("id").alias("file"))
    whole = header.unionAll(documents.select(line.alias("line"), F.col("doc_id").cast("bigint").alias("place"), file))
    ordered = whole.repartition("file").sortWithinPartitions("file", "place").drop("place")
    ordered.write.partitionBy("file").option("lineSep", "\r\n").text(path)
    staged = stage_csv(spark, path, glob="*.txt")
    return staged.data.select(F.col("c0").cast("bigint").alias("doc_id"), F.col("c1").alias("text"), F.col("c2").alias("lang"))


def several_files(spark: SparkSession, folder: str) -> str:
    """Three tables as files in one folder: two headers, one in latin-1 with rows too long, one that ends inside quotes."""
    path = scratch(spark, "several")
    c = table(spark, folder, "customer").orderBy("c_custkey")
    o = table(spark, folder, "orders").orderBy("o_orderkey")
    s = table(spark, folder, "supplier").orderBy("s_suppkey")
    lines = {
        "customer": ("key,name,link", c.select(F.format_string("%d,%s,https://x/%d", "c_custkey", "c_name", "c_custkey").alias("line"))),
        "orders": ("key,place,link", o.select(F.concat(
            F.format_string("%d,caf\u00e9 %s,https://x/%d", "o_orderkey", "o_orderstatus", "o_orderkey"),
            F.when(F.col("o_orderkey") % 10 == 5, ",more").otherwise("")).alias("line"))),
        "supplier": ("key,name,link", s.select(F.concat(
            F.format_string("%d,", "s_suppkey"), F.when(F.col("s_suppkey") == 1, '"').otherwise(""),
            F.format_string("%s,https://x/%d", "s_name", "s_suppkey")).alias("line"))),
    }
    for name, (header, frame) in lines.items():
        encoding = "ISO-8859-1" if name == "orders" else "UTF-8"
        writer = frame.withColumnRenamed("line", header).coalesce(1).write.option("header", "true").option("encoding", encoding)
        writer.option("quote", "\u0000").option("sep", "\u0001").csv(f"{path}/{name}")
    return path


@query("""
SELECT 'customer' AS file, CAST(c_custkey AS BIGINT) AS key, c_name AS name, CAST(NULL AS VARCHAR) AS place, CAST(c_custkey AS BIGINT) AS job_id FROM customer
UNION ALL
SELECT 'orders', o_orderkey, NULL, 'café ' || o_orderstatus, o_orderkey FROM orders WHERE o_orderkey % 10 <> 5""")
def files_of_two_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all readable files, each under its own header and in its own encoding."""
    staged = stage_csv(spark, several_files(spark, folder))
    at = dict(zip(staged.names, staged.columns))
    kind = staged.cells(staged.files).filter("column = '" + at["place"] + "'").select("_source", F.lit("orders").alias("_file"))
    return staged.data.join(F.broadcast(kind), "_source", "left").select(
        F.coalesce("_file", F.lit("customer")).alias("file"), F.col(at["key"]).cast("bigint").alias("key"),
        F.col(at["name"]).alias("name"), F.col(at["place"]).alias("place"), F.col("_key").alias("job_id"))


@query("""
SELECT 'customer' AS file, 'utf-8' AS working_encoding, true AS success, (SELECT count(*) FROM customer) AS raw_rows, 0 AS rejected_rows
UNION ALL SELECT 'orders', 'latin-1', true, (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 5), (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 5)
UNION ALL SELECT 'supplier', 'utf-8', false, NULL, 0 FROM (SELECT count(*) FROM supplier)""")
def files_of_two_headers_status(spark: SparkSession, folder: str) -> DataFrame:
    """One file is in another encoding and has rows too long; one cannot be read."""
    status = clean_files(spark, several_files(spark, folder)).status
    return status.select(
        F.element_at(F.split("file_path", "/"), -2).alias("file"), "working_encoding", "success", "raw_rows", "rejected_rows")


@query("""
SELECT CAST(c_custkey AS BIGINT) AS key, CAST(c_custkey AS BIGINT) AS job_id FROM customer""")
def files_without_odd_headers(spark: SparkSession, folder: str) -> DataFrame:
    """`schema_handling="skip"` leaves out files that lack a column most files have."""
    path = several_files(spark, folder)
    again = table(spark, folder, "customer").select("c_custkey", "c_name", F.lit("x").alias("c_link"))
    again.limit(0).toDF("key", "name", "link").coalesce(1).write.option("header", "true").csv(f"{path}/empty")
    staged = stage_csv(spark, path, schema_handling="skip")
    return staged.data.select(F.col("c0").cast("bigint").alias("key"), F.col("_key").alias("job_id"))


@query("""SELECT status, "columns", count(*) AS files FROM (
  SELECT 'Valid' AS status, '3 columns' AS "columns" FROM customer WHERE c_custkey = (SELECT min(c_custkey) FROM customer)
  UNION ALL SELECT CASE WHEN (SELECT count(*) FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10) WHERE o_orderkey % 10 = 5) > 0
    THEN '1 issues' ELSE 'Valid' END, '3 columns'
  UNION ALL SELECT 'Error: Failed to process file', 'N/A') GROUP BY ALL""")
def file_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: readable, with a long row among the first ten, not readable."""
    shown = reports.file_table(clean_files(spark, several_files(spark, folder)).status)
    return shown.groupBy("status", "columns").agg(F.count(F.lit(1)).alias("files"))


SAMPLED_SQL = """
lines AS (
  SELECT 'customer' AS file, c_custkey AS place, format('{},{},https://x/{}', c_custkey, c_name, c_custkey) AS line, false AS long FROM customer
  UNION ALL SELECT 'orders', o_orderkey, format('{},cafe {},https://x/{}', o_orderkey, o_orderstatus, o_orderkey) || CASE WHEN o_orderkey % 10 = 5 THEN ',more' ELSE '' END,
    o_orderkey % 10 = 5 FROM orders),
placed AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY place) AS n FROM lines),
sizes AS (SELECT file, sum(length(line) + 1) + CASE file WHEN 'customer' THEN 14 ELSE 15 END AS size,
  count(*) FILTER (long AND n <= 5) AS failed, count(*) FILTER (long AND n <= 10) AS issues FROM placed GROUP BY file)"""


@query(f"""
WITH {SAMPLED_SQL}
SELECT file, CASE WHEN failed > 0 THEN 'Error: a row has more fields than the header' WHEN issues > 0 THEN '1 issues' ELSE 'Valid' END AS status,
  CASE WHEN failed > 0 THEN 'N/A' ELSE '3 columns' END AS "columns",
  CASE WHEN failed > 0 THEN 'N/A' ELSE printf('%.2f MB', size / 1048576) END AS size FROM sizes
UNION ALL SELECT 'supplier', 'Error: Failed to process file', 'N/A', 'N/A' FROM (SELECT count(*) FROM supplier)""")
def file_table_of_samples(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file with its name and size; a file whose first rows cannot be sampled is an error."""
    path = several_files(spark, folder)
    staged = stage_csv(spark, path)
    status = clean_staged(staged, CleanOptions()).status
    names = status.select(F.col("file_name").alias("name"), F.element_at(F.split("file_path", "/"), -2).alias("file"))
    shown = reports.file_table(status, schema.schema_samples(staged))
    return shown.join(names, shown["file_name"] == names["name"]).select("file", "status", "columns", "size")


@query("""
SELECT DISTINCT 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS "columns",
  'bigint,string,bigint,double,string' AS types, 5 AS row_count_sample FROM customer""")
def schema_sample(spark: SparkSession, folder: str) -> DataFrame:
    path = as_csv(spark, table(spark, folder, "customer"), "customer-csv")
    samples = schema.schema_samples(stage_csv(spark, path))
    types = F.transform("columns", lambda c: F.element_at("dtypes", c))
    return samples.filter("error IS NULL").select(
        F.array_join("columns", ",").alias("columns"), F.array_join(types, ",").alias("types"),
        "row_count_sample").distinct()


@query("""
SELECT 2 AS files, 1 AS common_columns, false AS compatible,
  'Files have very few common columns (1)' AS issue FROM (SELECT count(*) FROM orders)""")
def schema_compatibility(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of two exports, read back from the files themselves."""
    tables = {
        "orders": messy(spark, folder, "orders", {"key": "o_orderkey", "o_custkey": "o_custkey", "link": "o_orderstatus"}),
        "customer": messy(spark, folder, "customer", {"key": "c_custkey", "c_name": "c_name"}),
    }
    columns = {}
    for name, frame in tables.items():
        found = assess_files(spark, as_csv(spark, frame, name)).select("header").distinct()
        columns[name] = N.header_names(found.first()[0])
    verdict = schema.compatibility(schema.column_table(columns, spark))
    return verdict.select("files", "common_columns", "compatible", F.element_at("issues", 1).alias("issue"))


DRIFT_OLD = {
    "o_orderstatus": "o_orderstatus", "key": "o_orderkey", "customer": "o_custkey", "total": "CAST(o_totalprice AS STRING)",
    "priority": "o_orderpriority", "note": "concat('n', CAST(o_orderkey AS STRING))", "placed": "CAST(o_orderdate AS DATE)", "blank": "CAST(NULL AS STRING)",
}
DRIFT_NEW = {
    "o_orderstatus": "o_orderstatus", "total": "CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE CAST(o_totalprice AS STRING) END",
    "key": "o_orderkey", "client": "o_custkey", "priority": "CAST(length(o_orderpriority) AS STRING)",
    "extra": "concat('x', CAST(o_orderkey AS STRING))", "placed": "o_orderkey % 2 = 0", "blank": "CASE WHEN o_orderkey % 9 = 0 THEN 'true' END",
}
DRIFT_ROWS = [
    ("key", "kept", "key", "whole", "whole"), ("client", "renamed", "customer", "whole", "whole"),
    ("total", "CASE WHEN nines > 0 THEN 'widened' ELSE 'kept' END", "total", "number", "CASE WHEN nines > 0 THEN 'text' ELSE 'number' END"),
    ("priority", "narrowed", "priority", "text", "whole"), ("note", "removed", "note", "text", None), ("extra", "added", None, None, "text"),
    ("placed", "changed", "placed", "date", "boolean"),
    ("blank", "CASE WHEN nines > 0 THEN 'widened' ELSE 'kept' END", "blank", "empty", "CASE WHEN nines > 0 THEN 'boolean' ELSE 'empty' END"),
]


def drift_sql() -> str:
    text = lambda x: "CAST(NULL AS VARCHAR)" if x is None else x if x.startswith("CASE") else f"'{x}'"
    names = ("column", "change", "old_column", "old_type", "new_type")
    return " UNION ALL ".join(
        "SELECT o_orderstatus, " + ", ".join(f'{text(x)} AS "{n}"' for n, x in zip(names, row)) + " FROM g" for row in DRIFT_ROWS)


@query(f"""
WITH g AS (SELECT o_orderstatus, count(*) FILTER (o_orderkey % 9 = 0) AS nines FROM orders GROUP BY o_orderstatus)
SELECT *, CASE WHEN change = 'renamed' THEN 1.0::DOUBLE END AS similarity FROM ({drift_sql()})""")
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """What became of the columns of each source since the kept snapshot: all kinds of change."""
    by, kept = ["o_orderstatus"], scratch(spark, "snapshots")
    drift.save_snapshot(drift.snapshot(messy(spark, folder, "orders", DRIFT_OLD), by), kept)
    now = drift.snapshot(messy(spark, folder, "orders", DRIFT_NEW), by)
    found = drift.drift(drift.load_snapshot(spark, kept), now, by)
    return found.select(*by, "column", "change", "old_column", "old_type", "new_type", "similarity")


@query("""
SELECT CAST(c_custkey AS BIGINT) AS key, c_name AS name, CAST(c_custkey AS BIGINT) AS job_id FROM customer""")
def cleaned_by_content(spark: SparkSession, folder: str) -> DataFrame:
    """Exports that come in two runs of a stream; one comes again under another name and is not cleaned twice."""
    path, output, state = scratch(spark, "arrivals"), scratch(spark, "stream"), scratch(spark, "state")
    customer = table(spark, folder, "customer")

    def export(part: int, name: str) -> None:
        rows = customer.filter(F.col("c_custkey") % 4 == part).select(
            F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.format_string("https://x/%d", "c_custkey").alias("link"))
        rows.write.option("header", "true").csv(f"{path}/{name}")

    for part in range(3):
        export(part, f"day1-{part}")
    clean_stream(spark, path, output, state)
    export(0, "moved")
    export(3, "day2")
    clean_stream(spark, path, output, state)
    return spark.read.parquet(f"{output}/data").select(F.col("key").cast("bigint").alias("key"), "name", "job_id")


@query("SELECT * FROM orders")
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    target = TableTarget("local-project", f"load_{uuid.uuid4().hex}", "orders",
                         location=scratch(spark, "warehouse"))
    outcome = load_table(table(spark, folder, "orders"), target)
    if not outcome["success"]:
        raise RuntimeError(outcome["error"])
    return spark.table(f"`{target.dataset}`.`{target.table}`")


@query("SELECT count(*) AS rows_uploaded, 6 AS columns_uploaded, true AS success FROM orders")
def sink_outcome(spark: SparkSession, folder: str) -> DataFrame:
    target = TableTarget("local-project", f"load_{uuid.uuid4().hex}", "orders",
                         location=scratch(spark, "warehouse"))
    outcome = load_table(table(spark, folder, "orders"), target)
    return spark.createDataFrame(
        [(outcome["rows_uploaded"], outcome["columns_uploaded"], outcome["success"])],
        "rows_uploaded bigint, columns_uploaded int, success boolean")
