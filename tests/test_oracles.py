"""Every registered query against its SQL, over whole tables."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry
from recordloom.checks.oracles import ORACLES
from recordloom.checks.queries import QUERIES


@pytest.fixture(scope="module")
def sql(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_what_the_sql_gives(spark, folder, sql, name):
    assert difference(QUERIES[name](spark, folder), sql, ORACLES[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 150
