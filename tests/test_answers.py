"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
import compare
from catalogue import oracles, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.queries()
SQL = oracles.oracles()


@pytest.fixture(scope="module")
def connection():
    return compare.database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_answer(spark, connection, name):
    assert compare.difference(QUERIES[name](spark, SF_DIR), connection, SQL[name]) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert frame.columns[:3] == ["environment", "databaseName", "tableName"]
