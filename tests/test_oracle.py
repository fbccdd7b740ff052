"""Every query against DuckDB on the same files.  ORACLE_SF picks another scale."""

import os

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from bindings import registry
from tests import oracle

FOLDER = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_the_comparison_notices_a_wrong_value(spark, con):
    df = registry.QUERIES["change_count"](spark, FOLDER)
    assert oracle.differences(df, con, "SELECT o_custkey, count(*) AS changes FROM orders GROUP BY 1")


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    assert oracle.differences(registry.QUERIES[name](spark, FOLDER), con, registry.ORACLES[name]) == []
