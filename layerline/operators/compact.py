"""Fewer, larger files for one partition."""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerline.sources import Dataset
from layerline.sources.folders import full_location
from layerline.sources.groups import gathered
from layerline.sources.paths import read_path, write_path


def compact(
    spark: SparkSession, source: Dataset, target: Dataset, target_file_bytes: int = 256 * 1024 * 1024
) -> DataFrame:
    """Rewrite the files of ``source`` as those of ``target`` and return what is there.

    The source stays as it is; point readers at the target once this returns. It
    raises if the target does not hold the rows that were read, by their number and
    a checksum of all columns. A source with partition directories needs a ``schema``:
    left to Spark, a value such as 000101 would be rewritten as the number 101.
    Files are joined without a shuffle, each output file from about
    ``target_file_bytes`` of input; only a target with ``partition_by`` is gathered
    by these columns.
    """
    for dataset in (source, target):
        if not dataset.by_path or dataset.type == "stream":
            raise ValueError(f"dataset '{dataset.name}': only files at a path are compacted")
    here, there = (full_location(spark, one.location) + "/" for one in (source, target))
    if here.startswith(there) or there.startswith(here):
        raise ValueError(f"{source.location} cannot be compacted into {target.location}; name another location")

    size, in_directories = _listing(spark, source.location)
    if in_directories and not source.schema:
        raise ValueError(f"dataset '{source.name}': files in partition directories need a 'schema' to be compacted")
    rows = read_path(spark, source)
    read = Observation()
    counted = rows.observe(read, *content(rows))
    if target.partition_by:
        packed = gathered(spark, target, counted, target.partition_by)
    else:
        packed = counted.coalesce(max(1, ceil(size / target_file_bytes)))
    write_path(spark, target, packed)

    compacted = spark.read.format(target.format).options(**target.options).schema(rows.schema).load(target.location)
    kept = compacted.agg(*content(rows)).first().asDict()
    if kept != read.get:
        raise RuntimeError(
            f"{source.location}: read {read.get['rows']} rows, found {kept['rows']} at {target.location}"
            + (", with other content" if kept["rows"] == read.get["rows"] else "")
        )
    return compacted


def _listing(spark: SparkSession, location: str) -> tuple[int, bool]:
    """Bytes of the files and whether they lie in partition directories; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    # Without file system, whose spelling differs between the two.
    root = re.sub("^[^:/]+://[^/]*", "", full_location(spark, location))
    path = F.regexp_replace("path", "^[^:/]+:(//[^/]*)?", "")
    below = F.substring(path, len(root) + 1, 2**31 - 1)
    found = files.agg(F.sum("length"), F.max(below.rlike("/[^/=]+=[^/]*/"))).first()
    return found[0] or 0, bool(found[1])


def content(rows: DataFrame) -> list[Column]:
    """The number of rows and the sum of their hashes. A map is hashed as its entries' text."""
    columns = [
        F.to_json(F.struct(F.col(f"`{one.name}`"))) if "map<" in one.dataType.simpleString() else F.col(f"`{one.name}`")
        for one in rows.schema
    ]
    checksum = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(checksum, F.lit(0).cast("decimal(38,0)")).alias("checksum")]
