"""Every named query equals its SQL twin."""

import pytest
from oracle_check import connect, difference

import __spark_entry__ as entry
from oracle.sql import oracle_sql
from tidewell.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_the_entry_names_them_all():
    assert set(QUERIES) <= set(entry.queries())
    assert ORACLE.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert difference(got, duck.execute(ORACLE[name]).df()) is None
