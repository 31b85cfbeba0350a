"""Every named query against its SQL on the smallest test tables."""

import os

import pytest
from compare import compare, connect
from conftest import TESTDATA

import __spark_entry__ as entry
from sql_checks import CHECKS
from wardflow.specs import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_checks_match_queries():
    missing = set(entry.oracle_sql()) - set(entry.queries())
    assert not missing
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, TESTDATA)
    assert compare(df, con, entry.oracle_sql()[name]) == []

