"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5 and rows[0].asDict().keys() == {"sys_device_name", "n_rows", "revenue"}


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    assert compare(spark, duck, name, QUERIES[name], SQL.get(name), sf) == ""
