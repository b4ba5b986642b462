"""Global order and the first rows of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CAME_FROM, _CONTENT = "__layerline_came_from", "__layerline_content"


def sort_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Ascending, NULLs first; rows with equal keys are in no particular order.

    A plain ``orderBy`` sends all rows with the same key to one task. Two more keys
    let range boundaries fall inside a hot key: a hash of the row, which parts
    different rows, and the partition a row comes from, which parts copies. Only
    copies from one partition stay together. A row position would do as well, but
    it may change when a lost task is repeated.
    """
    # A map has no hash; rows that differ in a map alone count as copies here.
    hashed = [F.col(f"`{field.name}`") for field in df.schema if "map<" not in field.dataType.simpleString()]
    content = F.xxhash64(*hashed) if hashed else F.lit(0)
    more = {_CONTENT: content, _CAME_FROM: F.spark_partition_id()}
    return df.withColumns(more).orderBy(*keys, *more).drop(*more)


def preview(df: DataFrame, *keys: str, rows: int = 20) -> DataFrame:
    """The first rows of the order: each task keeps its own first, only those are merged."""
    return df.orderBy(*keys).limit(rows)
