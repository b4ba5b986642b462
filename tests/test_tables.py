from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from unittest.mock import MagicMock
from uuid import uuid4

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from layerline import RunContext
from layerline.sources import Dataset
from layerline.sources.catalog import is_file_table, table_format, write_table
from layerline.sources.provision import TableDefinition, create_tables
from tests.conftest import rows

ORDERS = [(1, 10, "F", 1.25), (2, 20, "O", 2.0), (3, 30, "F", 3.5)]
SCHEMA = "order_id BIGINT, customer_id BIGINT, status STRING, amount DOUBLE"


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(ORDERS, SCHEMA)


@pytest.fixture
def table(spark, table_run, store):
    def _table(mode, partitioned=False):
        domain = f"d{uuid4().hex}"
        by = "PARTITIONED BY (status)" if partitioned else ""
        ddl = f"CREATE TABLE ${{name}} ({SCHEMA}) USING ${{format}} {by} LOCATION '${{warehouse}}/{domain}'"
        create_tables(spark, [TableDefinition("refined", domain, "orders", ddl)], table_run)
        return store({"type": "table", "table": f"refined.{domain}.orders", "mode": mode}, at=table_run)

    return _table


def by_id(df):
    return rows(df.select("order_id", "customer_id", "status", "amount"))


@pytest.mark.parametrize("partitioned", [False, True])
def test_append_matches_by_name_and_adds(table, orders, partitioned):
    write, read = table("append", partitioned)
    swapped = orders.select("status", "amount", "customer_id", "order_id")
    write(swapped.where("status = 'F'"))
    write(swapped.where("status = 'O'"))
    assert by_id(read()) == ORDERS
    write(orders)
    assert by_id(read()) == sorted(ORDERS * 2)


@pytest.mark.parametrize("mode", ["append", "overwrite_partitions"])
def test_other_columns_are_refused(table, orders, mode):
    write, read = table(mode, partitioned=True)
    with pytest.raises(ValueError, match=r"missing \['amount'\], extra \[\]"):
        write(orders.drop("amount"))
    with pytest.raises(ValueError, match=r"missing \[\], extra \['more'\]"):
        write(orders.withColumn("more", F.lit(1)))
    assert read().count() == 0


def test_names_match_in_any_case_unless_the_session_says_otherwise(table, orders, set_conf):
    write, read = table("append")
    shouted = orders.withColumnRenamed("status", "STATUS")
    write(shouted)
    assert by_id(read()) == ORDERS
    set_conf("spark.sql.caseSensitive", "true")
    with pytest.raises(ValueError, match=r"missing \['status'\], extra \['STATUS'\]"):
        write(shouted)


def test_overwrite_partitions_leaves_the_others(spark, table, orders):
    write, read = table("overwrite_partitions", partitioned=True)
    write(orders)
    fewer = orders.where("order_id = 3").select("amount", "customer_id", "order_id", "status")
    write(fewer)
    write(fewer)
    assert by_id(read()) == ORDERS[1:]
    write(orders.where("order_id = 0"))
    assert by_id(read()) == ORDERS[1:]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_the_null_partition_is_a_partition(spark, table, orders):
    write, read = table("overwrite_partitions", partitioned=True)
    write(orders.unionByName(spark.createDataFrame([(4, 40, None, 4.0), (5, 50, None, 5.0)], SCHEMA)))
    write(spark.createDataFrame([(6, 60, None, 6.0)], SCHEMA))
    assert by_id(read()) == [*ORDERS, (6, 60, None, 6.0)]


def test_a_table_that_is_not_there(spark, table_run, store):
    write, _ = store({"type": "table", "table": "refined.nowhere.orders", "mode": "append"}, at=table_run)
    with pytest.raises(AnalysisException, match="NOT_FOUND"):
        write(spark.range(1))


def test_overwrite_partitions_of_a_table_without_partitions_replaces_it(table, orders):
    write, read = table("overwrite_partitions")
    write(orders)
    write(orders.where("order_id = 2"))
    assert by_id(read()) == ORDERS[1:2]


def test_overwrites_at_the_same_time(table, orders):
    """Nothing is set on the session, so writes to several tables do not affect each other."""
    tables = [table("overwrite_partitions", partitioned=True) for _ in range(6)]
    for write, _ in tables:
        write(orders)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda one: one[0](orders.where("order_id = 3")), tables))
    assert [by_id(read()) for _, read in tables] == [ORDERS[1:]] * 6


def test_a_partition_may_be_rewritten_from_itself(table, orders):
    write, read = table("overwrite_partitions", partitioned=True)
    write(orders)
    write(read().where("status = 'F'").withColumn("amount", F.col("amount") + 1))
    assert by_id(read()) == [(1, 10, "F", 2.25), (2, 20, "O", 2.0), (3, 30, "F", 4.5)]


def test_rows_are_counted_by_the_write(table, orders):
    write, _ = table("append", partitioned=True)
    assert write(orders, count_rows=True) == 3


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("mode", ["append", "overwrite_partitions"])
def test_no_rows_are_counted_as_none(spark, table, orders, mode, partitioned):
    write, read = table(mode, partitioned)
    for nothing in (orders.where("order_id = 0"), orders.where(F.lit(False)), spark.createDataFrame([], SCHEMA)):
        assert write(nothing, count_rows=True) == 0
    assert read().count() == 0


@pytest.mark.parametrize(("mode", "call"), [("append", "append"), ("overwrite_partitions", "overwritePartitions")])
def test_other_catalogs_are_written_with_their_own_writer(mode, call):
    """There is no such catalog here to write to, so this checks the call only."""
    spark, df = MagicMock(), MagicMock(columns=["id"])
    spark.conf.get = lambda key, default=None: {
        "spark.sql.caseSensitive": "false",
        "spark.sql.catalog.iceberg": "org.example.Catalog",
    }.get(key, default)
    spark.table.return_value.columns = ["id"]
    dataset = Dataset("orders", "table", "iceberg.refined.sample.orders", by_path=False, mode=mode)
    write_table(spark, dataset, df)
    df.writeTo.assert_called_once_with("`iceberg`.`refined`.`sample`.`orders`")
    getattr(df.writeTo.return_value, call).assert_called_once_with()
    spark.sql.assert_not_called()


@pytest.mark.parametrize(("provider", "files"), [("parquet", True), ("ORC", True), ("iceberg", False), (None, False)])
def test_the_provider_decides_how_a_table_is_written(provider, files):
    """Also where the session catalog is not Spark's own and holds tables of several kinds."""
    spark = MagicMock()
    spark.conf.get = lambda key, default=None: {"spark.sql.catalog.spark_catalog": "org.example.Catalog"}.get(key, default)
    found = spark.sql.return_value.where.return_value.first
    found.return_value = None if provider is None else MagicMock(data_type=provider)
    assert is_file_table(spark, "spark_catalog.refined__sample.orders") is files
    assert table_format(spark, RunContext(catalog="spark_catalog")) == "iceberg"
