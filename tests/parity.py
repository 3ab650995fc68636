"""Compare registered queries with their SQL on the same tables.

Run as a script: `python tests/parity.py [sf_dir] [query ...]`.
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def in_order(rows, columns):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in places]
    cells = [tuple(plain(row[i]) for i in places) for row in rows]
    return names, sorted(cells, key=repr)


def expected(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return in_order(cursor.fetchall(), columns)


def actual(frame):
    return in_order([tuple(r) for r in frame.collect()], frame.columns)


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in chosen:
        start = time.time()
        try:
            got = actual(queries()[name](spark, folder))
            took = time.time() - start
            if name not in oracle_sql():
                print(f"----  {name}: {len(got[1])} rows, no SQL, {took:.1f}s")
                continue
            want = expected(connection, oracle_sql()[name])
            same = got == want
            print(f"{'ok' if same else 'DIFF':5} {name}: {len(got[1])} rows, {took:.1f}s", flush=True)
            if not same:
                print("   ", got[0], want[0], len(got[1]), len(want[1]))
                extra = [r for r in got[1] if r not in set(want[1])][:3]
                lacking = [r for r in want[1] if r not in set(got[1])][:3]
                print("    only here:", extra, "\n    only there:", lacking)
        except Exception as error:
            print(f"FAIL  {name}: {str(error)[:600]}", flush=True)
