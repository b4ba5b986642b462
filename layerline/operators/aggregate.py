"""Grouped counts and totals.

Both reduce to one row per group and task before the shuffle, so a group that
holds most of the rows costs no more than any other. NULL is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerline.functions import total


def group_counts(df: DataFrame, *keys: str, count_as: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count_as))


def group_totals(df: DataFrame, *keys: str, total_of: str, count_as: str, total_as: str) -> DataFrame:
    """Row count and rounded total. NULL amounts do not add; a group of only NULLs has a NULL total."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_as), total(total_of).alias(total_as))
