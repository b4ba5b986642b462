"""What the registered queries ask of Spark."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from tests.conftest import TESTDATA

QUERIES = {name: query for name, query in contract.queries().items() if name in contract._QUERIES}


def plan(spark, name):
    return QUERIES[name](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_leaves_the_jvm_pairs_rows_or_gathers_them(spark, name):
    text = plan(spark, name)
    assert not re.search("Python|Pandas|Broadcast|Cartesian|NestedLoop", text)
    # A total over everything merges one row per task.
    assert "SinglePartition" not in text or "partial_count" in text


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("scan_path_parquet", 0),
        ("scan_table", 0),
        ("scan_run_partition", 0),
        ("agg_group_count", 1),
        ("agg_group_sum_rounded", 1),
        ("job_orders_summary", 2),
        ("sort_orders", 1),
        ("topn_preview", 0),
        ("compact_partition", 0),
    ],
)
def test_shuffles(spark, name, shuffles):
    assert plan(spark, name).count("Exchange ") == shuffles


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("agg_group_count", "o_orderstatus:string"),
        ("job_orders_summary", "o_orderstatus:string,o_totalprice:double"),
    ],
)
def test_columns_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


def test_unused_columns_of_a_table_are_not_read(spark):
    assert "o_orderpriority" not in plan(spark, "scan_table")


def test_the_first_rows_are_taken_before_they_are_merged(spark):
    assert "TakeOrderedAndProject" in plan(spark, "topn_preview")


def test_a_day_reaches_the_scan(spark):
    events = contract._given(spark, TESTDATA, "events")
    day = events.where("cast(ts AS date) = DATE '2024-01-02'")
    text = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in text
    assert "LessThan(ts,2024-01-03T00:00)" in text
