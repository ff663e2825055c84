"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert compare(df, con, SQL[name]) in ("", "both empty")
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
