"""Every registered query against its SQL, over the smallest tables."""

from __future__ import annotations

from pathlib import Path
from unittest.mock import MagicMock

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import TESTDATA

# The queries of the training-data operators have tests of their own.
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in contract._QUERIES}
QUERIES = {name: query for name, query in contract.queries().items() if name in contract._QUERIES}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(TESTDATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def by_name(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(row[i] for i in order) for row in data), key=repr)


def test_each_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, oracle, name):
    df = QUERIES[name](spark, TESTDATA)
    wanted = oracle.sql(SQL[name])
    found = by_name(df.columns, df.collect())
    assert found == by_name(wanted.columns, wanted.fetchall())
    assert found[1]


def test_queries_leave_one_database_each(spark):
    for _ in range(2):
        QUERIES["scan_table"](spark, TESTDATA).count()
    names = [row.namespace for row in spark.sql("SHOW NAMESPACES").collect()]
    assert len([name for name in names if name.startswith("raw__scan_table_")]) == 1


def test_a_local_session_without_a_shared_folder_gets_one():
    spark = MagicMock()
    spark.conf.get = lambda key, default=None: default
    spark.sparkContext.master, spark.sparkContext.applicationId = "local[2]", "app-1"
    contract._with_shared_folder(lambda spark, sf_dir: None)(spark, TESTDATA)
    (key, folder), _ = spark.conf.set.call_args
    assert key == "spark.layerline.staging.dir" and folder.endswith("layerline-app-1")
    spark.conf.set.reset_mock()
    spark.sparkContext.master = "yarn"
    contract._with_shared_folder(lambda spark, sf_dir: None)(spark, TESTDATA)
    spark.conf.set.assert_not_called()


def test_entry(spark):
    assert contract.entry(spark).columns == ["status", "order_count", "total_amount"]


def test_sort_is_in_order(spark):
    keys = [row.order_id for row in QUERIES["sort_orders"](spark, TESTDATA).collect()]
    assert keys == sorted(keys)
