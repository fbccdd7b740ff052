"""Shapes that must hold whatever the size of the data."""

import re

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from bindings import registry
from martloom.operators import skew
from tests.helpers import plan

FOLDER = "/root/testdata/sf0.001"
# A window without a key over one row per partition; for geo_nearest_customer the single
# task adds up the cells that have points, whose number the sphere bounds.
SINGLE_TASK_OK = {"numbered_rows", "array_pair", "geo_nearest_customer"}


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {name: plan(q(spark, FOLDER)) for name, q in registry.QUERIES.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_query_pairs_everything_with_everything(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p] == []


def test_queries_leave_the_sizing_to_the_session(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get(name, None)
    registry.QUERIES["agg_basic"](spark, FOLDER)
    assert (spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get(name, None)) == before


def test_no_python_in_the_rows_path(plans):
    assert [n for n, p in plans.items() if "Python" in p or "Pandas" in p] == []


def _gathers_rows(text):
    """Whether a single partition gathers more than a row per range partition or per task of a
    global aggregate."""
    lines = text.splitlines()
    folded = re.compile(r"Aggregate\(keys?=\[(_part#\d+)?\]")
    return any("Exchange SinglePartition" in line and not any(folded.search(x) for x in lines[i + 1 : i + 4])
               for i, line in enumerate(lines))


def test_no_window_gathers_a_whole_table(plans):
    bad = [n for n, p in plans.items() if n not in SINGLE_TASK_OK and "Window" in p and _gathers_rows(p)]
    assert bad == []
    assert _gathers_rows("Window\n+- Exchange SinglePartition, X\n   +- Project [a]\n      +- Scan")


def test_day_filters_reach_the_scan(plans):
    for name in ("scan_events_day", "trailing_week"):
        pushed = plans[name].split("PushedFilters")[1]
        assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_scans_read_only_needed_columns(plans):
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plans["visited_set"]
    assert "p_name" not in plans["filter_prefix"]


def test_hot_customer_is_split(spark):
    """A third of the lines under one key: the join spreads them over the salts."""
    lines = spark.range(9_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id")
    dim = spark.range(9_000).selectExpr("id AS k", "id * 2 AS v")
    joined = skew.skew_join(lines, dim, "k")
    assert "_salt" in plan(joined) and joined.count() == 9_000
