"""Datasets that are catalog tables.

Tables are defined first (see provision.py); a write never changes a schema.
Columns are matched by name, never by position.
"""

from __future__ import annotations

import json
from collections import Counter
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from layerline.sources.run import SESSION_CATALOG, RunContext
from layerline.sources.specs import Dataset


# Formats whose tables are files that Spark itself writes; ``writeTo`` refuses them.
FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro", "hive")


def quoted(name: str) -> str:
    """A dotted name for a statement, each part quoted, so that hyphens and the like are no trouble."""
    return ".".join(quoted_part(part) for part in name.split("."))


def quoted_part(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_table(spark: SparkSession, dataset: Dataset) -> DataFrame:
    return spark.table(quoted(dataset.location))


def write_table(spark: SparkSession, dataset: Dataset, df: DataFrame) -> None:
    check_same_columns(spark, dataset, df)
    overwrite = dataset.mode == "overwrite_partitions"
    table = quoted(dataset.location)
    if not is_file_table(spark, dataset.location):
        writer = df.writeTo(table)
        writer.overwritePartitions() if overwrite else writer.append()
    elif overwrite:
        # The option belongs to this one statement. A session setting would also
        # reach other writes, and those running at the same time in other threads.
        spark.sql(
            f"INSERT OVERWRITE {table} WITH (partitionOverwriteMode = 'dynamic') "
            "BY NAME SELECT * FROM {rows}",
            rows=df,
        )
    else:
        spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=df)


def check_same_columns(spark: SparkSession, dataset: Dataset, df: DataFrame) -> None:
    """INSERT ... BY NAME would fill a column missing from ``df`` with NULL."""
    same_case = spark.conf.get("spark.sql.caseSensitive").lower() == "true"

    def names(columns: list[str]) -> Counter:
        return Counter(columns if same_case else [column.lower() for column in columns])

    # The write resolves the table as well, and Spark keeps what it found.
    wanted, given = names(spark.table(quoted(dataset.location)).columns), names(df.columns)
    if wanted != given:
        raise ValueError(
            f"dataset '{dataset.name}': columns differ from {dataset.location}: "
            f"missing {sorted(wanted - given)}, extra {sorted(given - wanted)}"
        )


def on_session_catalog(spark: SparkSession, table: str) -> bool:
    first = table.split(".")[0]
    if first == SESSION_CATALOG:
        return True
    if spark.conf.get(f"spark.sql.catalog.{first}", None):
        return False
    return spark.catalog.currentCatalog() == SESSION_CATALOG


def is_file_table(spark: SparkSession, table: str) -> bool:
    """Whether the table is made of files that Spark writes itself, by the format it was created with.

    The session catalog may hold tables of other kinds too, where an
    implementation of its own is put in its place. Other catalogs hold no such
    file tables.
    """
    if not on_session_catalog(spark, table):
        return False
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("lower(col_name) = 'provider'").first()
    return described is not None and described.data_type.lower() in FILE_FORMATS


def table_format(spark: SparkSession, run: RunContext) -> str:
    """What new tables are made of: files on Spark's own session catalog, Iceberg on any other."""
    builtin = spark.conf.get(f"spark.sql.catalog.{SESSION_CATALOG}", "builtin") == "builtin"
    return "parquet" if builtin and on_session_catalog(spark, run.table_name("x.y.z")) else "iceberg"


def partition_columns(spark: SparkSession, dataset: Dataset) -> tuple[str, ...]:
    """Partition columns of a file table; tables of other kinds arrange their writes themselves."""
    if not is_file_table(spark, dataset.location):
        return ()
    return tuple(describe_file_table(spark, dataset.location).get("partition_columns", ()))


def describe_partition(spark: SparkSession, table: str, clause: str) -> dict[str, Any]:
    """What the session catalog holds about one partition, among it where it lies now."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} {clause} AS JSON").first()[0])


def describe_file_table(spark: SparkSession, table: str) -> dict[str, Any]:
    """What the session catalog holds about a table; no file is listed for it."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} AS JSON").first()[0])
