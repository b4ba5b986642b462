"""The tables this repository's jobs write to, and the job that provides them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from layerline.plans.orders import ORDER_SCHEMA
from layerline.sources import RunContext
from layerline.sources.provision import TableDefinition, create_tables, drop_table

TABLES = (
    TableDefinition(
        "refined",
        "sample",
        "orders",
        f"CREATE TABLE IF NOT EXISTS ${{name}} ({ORDER_SCHEMA}) USING ${{format}} "
        "LOCATION '${warehouse}/${layer}/${domain}/${table}'",
    ),
    TableDefinition(
        "refined",
        "sample",
        "orders_by_day",
        f"CREATE TABLE IF NOT EXISTS ${{name}} ({ORDER_SCHEMA}, ymd STRING) USING ${{format}} "
        "PARTITIONED BY (ymd) "
        "LOCATION '${warehouse}/${layer}/${domain}/${table}'",
    ),
)


def apply_catalog(
    spark: SparkSession,
    run: RunContext,
    layer: str | None = None,
    domain: str | None = None,
    table: str | None = None,
) -> list[str]:
    """Create the selected tables where they are absent; return their full names."""
    return create_tables(spark, TABLES, run, layer, domain, table)


def drop_from_catalog(spark: SparkSession, run: RunContext, layer: str, domain: str, table: str) -> None:
    """Drop one table. The files of a table with a location stay."""
    drop_table(spark, run, layer, domain, table)
