"""Every registered query against its SQL twin on whole tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences

SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in contract.catalog.QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert differences(con, contract.queries()[name](spark, sf_dir), SQL[name]) == ""


def test_every_query_has_sql():
    assert contract.catalog.QUERIES.keys() == SQL.keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
