"""Every registered query that has SQL against it, on the smallest tables."""

import parity
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from millrace.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return parity.connect(SF)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, connection, name):
    got = parity.actual(queries()[name](spark, SF))
    assert got == parity.expected(connection, oracle_sql()[name])


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
