"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from genoloom.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = catalogue.queries(), catalogue.oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_lazy_and_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, con, key):
    _, problem = compare(QUERIES[key](spark, SF), con, ORACLES[key])
    assert problem is None, problem
