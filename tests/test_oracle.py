"""Every registered query against its SQL on the same tables."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as entry_point
from hitframe.workloads import catalog, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = dict(catalog.QUERIES), oracle.sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert SQL.keys() <= entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_known_counts(spark):
    assert QUERIES["charge_asymmetry"](spark, SF_DIR).count() == 661
    assert QUERIES["plane_coincidence"](spark, SF_DIR).count() == 418
    pairs = QUERIES["edge_pairing"](spark, SF_DIR)
    assert pairs.groupBy().sum("n_pairs").first()[0] == 7589


def test_entry(spark):
    assert entry_point.entry(spark).count() == 67
