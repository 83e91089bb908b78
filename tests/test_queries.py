"""Every registered query equals its SQL, value by value."""

import pytest

import __spark_entry__ as entry_point
from shelfline.catalog.oracles import ORACLES as SQL
from shelfline.catalog.queries import QUERIES
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), SQL[name], con) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() == 50
