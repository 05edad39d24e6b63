"""Every registered query against its SQL equivalent on the smallest tables."""

import pytest

import __spark_entry__ as entry
from adloom.oracle import ORACLE
from adloom.registry import QUERIES
from oracle_check import compare, connect


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, tiny, name):
    verdict, n = compare(spark, con, name, tiny)
    assert verdict == "match"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 3
