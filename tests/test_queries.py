"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import compare
import pytest

import __spark_entry__ as entry_point
from tidemark.workload import QUERIES as registered
from tidemark.workload import runnable

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

# The queries that may have been removed have tests of their own.
QUERIES = {name: runnable(q.build) for name, q in registered.items()}
SQL = {name: sql for name, sql in entry_point.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return compare.oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare.mismatch(QUERIES[name](spark, FOLDER), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(registered) <= set(entry_point.queries())
