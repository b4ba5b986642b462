"""Order jobs."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerline.functions import conform, day_of
from layerline.operators import group_totals
from layerline.sources import DatasetGroup, RunContext, read_dataset

logger = logging.getLogger(__name__)

# The columns, places and table names the order jobs share.
ORDER_SCHEMA = "order_id BIGINT, customer_id BIGINT, status STRING, amount DOUBLE, order_date STRING"

SUMMARY_SPECS = {
    "input": {"orders": {"type": "path", "path": "raw/sample/orders/orders.parquet", "format": "parquet"}},
}

INGEST_SPECS = {
    "input": {"orders_seed": {"type": "path", "path": "raw/sample/orders/orders.parquet", "format": "parquet"}},
    "output": {"orders": {"type": "table", "table": "refined.sample.orders", "mode": "append"}},
}

# The same for a run that may be repeated: under one day and time its rows are there once.
ONCE_SPECS = {
    "input": INGEST_SPECS["input"],
    "output": {"orders": {**INGEST_SPECS["output"]["orders"], "once": "orders-{ymd}-{hms}"}},
}

# All rows of a run go to the partition of its day, so there is nothing to gather first.
RERUN_SPECS = {
    "input": INGEST_SPECS["input"],
    "output": {
        "orders": {
            "type": "table",
            "table": "refined.sample.orders_by_day",
            "mode": "overwrite_partitions",
            "rebalance": False,
        }
    },
}


def from_tpch_orders(orders: DataFrame) -> DataFrame:
    """The ``o_...`` columns of an order table, named and typed as ``ORDER_SCHEMA``."""
    return conform(
        orders,
        {
            "order_id": F.col("o_orderkey"),
            "customer_id": F.col("o_custkey"),
            "status": F.col("o_orderstatus"),
            "amount": F.col("o_totalprice"),
            "order_date": day_of("o_orderdate"),
        },
    )


def orders_summary(
    spark: SparkSession,
    inputs: DatasetGroup,
    outputs: DatasetGroup,
    run: RunContext,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    metrics: Observation | None = None,
) -> DataFrame:
    """Count and total amount by status, in status order.

    ``prepare`` gives the orders the columns of ``ORDER_SCHEMA`` where they differ.
    With ``metrics``, the summary is written to the output ``summary`` and read
    back. The write sees all groups, whatever the caller does with the result, so
    ``source_rows`` and ``groups`` are whole when this returns. The source rows
    are the sum of the group counts and cost no second pass.
    """
    run.require_batch()
    orders = inputs.read("orders")
    if prepare:
        orders = prepare(orders)
    summary = group_totals(orders, "status", total_of="amount", count_as="order_count", total_as="total_amount")
    if metrics is not None:
        source_rows = F.coalesce(F.sum("order_count"), F.lit(0)).alias("source_rows")
        outputs.write("summary", summary.observe(metrics, source_rows, F.count(F.lit(1)).alias("groups")))
        logger.info("orders summary: %s", metrics.get)
        summary = read_dataset(spark, outputs["summary"])
    return summary.orderBy("status")


def orders_ingest(
    spark: SparkSession,
    inputs: DatasetGroup,
    outputs: DatasetGroup,
    run: RunContext,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Move the seed orders to the refined dataset and return that.

    The table of ``INGEST_SPECS`` is appended to, so a second run adds the rows a
    second time; with ``ONCE_SPECS`` it does not, under the same day and time. With ``RERUN_SPECS``, a run replaces what an earlier run of its day
    wrote: the rows carry ``ymd``, and the table is partitioned by it.
    """
    run.require_batch()
    orders = inputs.read("orders_seed")
    if prepare:
        orders = prepare(orders)
    target = outputs["orders"]
    if target.mode == "overwrite_partitions":
        orders = orders.withColumn("ymd", F.lit(run.ymd))
    rows = outputs.write("orders", orders, count_rows=True)
    logger.info("orders ingest: %s rows to %s", rows, target.location)
    return read_dataset(spark, target)
