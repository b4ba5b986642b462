"""Fewer, larger files for the partitions of a table that have many small ones, and a switch of its readers to them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from layerline.operators.compact import content
from layerline.sources.catalog import describe_file_table, describe_partition, is_file_table, quoted, text_literal
from layerline.sources.folders import folder_entries, full_location, remove_folder
from layerline.sources.once import partition_clause, partition_values
from layerline.sources.specs import Dataset

#: Where compacted partitions lie, below the table's location; hidden, so that no one takes them for partitions twice.
COMPACTED = ".compacted"


class Partition(NamedTuple):
    """One that is worth rewriting: its directory's name, where it lies, and its files now and after."""

    directory: str
    location: str
    files: int
    bins: int


class Switched(NamedTuple):
    directory: str
    old: str
    new: str


def compaction_plan(
    spark: SparkSession, dataset: Dataset, target_file_bytes: int = 256 * 1024 * 1024
) -> tuple[list[Partition], DataFrame]:
    """The partitions whose files could be at most half as many, and ``file``, ``directory``, ``bin`` of their files.

    From one listing of the table; no file is opened. Files of a partition are packed by
    their running size, the largest first, into bins of about ``target_file_bytes``.
    Directories that the catalog does not know are left alone.
    """
    described = _described(spark, dataset)
    root, depth = full_location(spark, described["location"]), len(described["partition_columns"])
    folders = [root, *(f"{root}/{COMPACTED}/{name}" for name in folder_entries(spark, f"{root}/{COMPACTED}"))]
    listed = reduce(DataFrame.unionAll, (_listed(spark, folder, depth) for folder in folders))
    known = spark.sql(f"SHOW PARTITIONS {quoted(dataset.location)}").select(F.col("partition").alias("directory"))
    listed = listed.join(known, "directory", "left_semi")
    order = Window.partitionBy("directory", "folder").orderBy(F.desc("size"), "file")
    packed = listed.withColumn("bin", F.floor((F.sum("size").over(order) - F.col("size")) / target_file_bytes).cast("int"))
    sums = packed.groupBy("directory", "folder").agg(F.count("*").alias("files"), (F.max("bin") + 1).alias("bins"))
    # A partition that was compacted before has files in more than one place; the catalog says which are in use.
    places = F.count("*").over(Window.partitionBy("directory"))
    worth = sums.withColumn("places", places).where("files >= 2 * bins").orderBy("directory", "folder").collect()
    chosen = []
    for row in worth:
        location = f"{row.folder}/{row.directory}"
        if row.places > 1 or row.folder != root:
            values = partition_clause(partition_values(row.directory))
            if full_location(spark, describe_partition(spark, dataset.location, values)["location"]) != location:
                continue
        chosen.append(Partition(row.directory, location, row.files, row.bins))
    inside = spark.createDataFrame([(one.location,) for one in chosen], "location string")
    packed = packed.withColumn("location", F.concat_ws("/", "folder", "directory")).join(inside, "location", "left_semi")
    return chosen, packed.select("file", "directory", "bin")


def compact_table(spark: SparkSession, dataset: Dataset, target_file_bytes: int = 256 * 1024 * 1024) -> list[Switched]:
    """Rewrite what ``compaction_plan`` chooses in one job and point the table's partitions at it.

    Readers by name see a partition's old files until its switch and the new ones after
    it, never both. It raises, and the table is as before, if the new files do not hold the
    rows that were read, by number and a checksum of all columns, or if a switch fails. Old
    files stay for readers that have begun; ``remove_replaced`` drops them later. For one
    writer at a time. A table made anew over the location finds the old places only, so
    remove the old files no sooner than needed and keep the catalog.
    """
    chosen, packed = compaction_plan(spark, dataset, target_file_bytes)
    if not chosen:
        return []
    described = _described(spark, dataset)
    columns, root = described["partition_columns"], full_location(spark, described["location"])
    place = f"{root}/{COMPACTED}/{uuid.uuid4().hex}"
    schema = spark.table(quoted(dataset.location)).schema

    # A number for each bin of all partitions, which is also that of the task that writes it.
    first, before = [], 0
    for one in chosen:
        first.append((one.directory, before))
        before += one.bins
    numbers = spark.createDataFrame(first, "directory string, before int")
    bins = packed.join(numbers, "directory").select("file", (F.col("before") + F.col("bin")).alias("number"))
    rows = reduce(DataFrame.unionByName, _read(spark, described, schema, chosen))
    file, number = "__compacted_file", "__compacted_bin"
    placed = rows.join(bins.toDF(file, number), file).drop(file).repartitionById(before, F.col(number)).drop(number)
    # Above the shuffle: tasks below it may run more than once.
    read = Observation()
    placed.observe(read, *content(placed)).write.format(described["provider"]).partitionBy(*columns).save(place)

    try:
        written = spark.read.format(described["provider"]).schema(schema).load(place)
        kept = written.agg(*content(written)).first().asDict()
        if kept != read.get:
            raise RuntimeError(f"{dataset.location}: read {read.get} and wrote {kept}, so its partitions stay as they are")
        return _switch(spark, dataset, [Switched(one.directory, one.location, f"{place}/{one.directory}") for one in chosen])
    except BaseException:
        remove_folder(spark, place)
        raise


def remove_replaced(spark: SparkSession, switched: list[Switched]) -> None:
    """Drop the files that a compaction replaced, once no reader that began before it is left."""
    for one in switched:
        remove_folder(spark, one.old)


def _switch(spark: SparkSession, dataset: Dataset, wanted: list[Switched]) -> list[Switched]:
    done = []
    try:
        for one in wanted:
            done.append(one)
            _set_location(spark, dataset, one.directory, one.new)
    except BaseException:
        for one in reversed(done):
            _set_location(spark, dataset, one.directory, one.old)
        raise
    finally:
        spark.catalog.refreshTable(quoted(dataset.location))
    return done


def _set_location(spark: SparkSession, dataset: Dataset, directory: str, location: str) -> None:
    values = partition_clause(partition_values(directory))
    spark.sql(f"ALTER TABLE {quoted(dataset.location)} {values} SET LOCATION {text_literal(location)}")


def _described(spark: SparkSession, dataset: Dataset) -> dict:
    if dataset.by_path or not is_file_table(spark, dataset.location):
        raise ValueError(f"dataset '{dataset.name}': only a catalog table of files has partitions to switch")
    described = describe_file_table(spark, dataset.location)
    if not described.get("partition_columns"):
        raise ValueError(f"dataset '{dataset.name}': {dataset.location} has no partitions to switch")
    return described


def _listed(spark: SparkSession, folder: str, depth: int) -> DataFrame:
    """``file`` as a scan names it, ``size``, ``directory`` (of the partition) and ``folder``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    file = F.col("_metadata.file_path")
    parts = F.split(F.url_decode(F.regexp_replace(file, r"\+", "%2B")), "/")
    directory = F.array_join(F.slice(parts, -1 - depth, depth), "/")
    listed = files.select(file.alias("file"), F.col("length").alias("size"), directory.alias("directory"))
    return listed.withColumn("folder", F.lit(folder))


def _read(spark: SparkSession, described: dict, schema, chosen: list[Partition]) -> Iterator[DataFrame]:
    """The rows of the chosen partitions and ``__compacted_file``, by the folder under which they lie."""
    folders: dict[str, list[str]] = {}
    for one in chosen:
        folders.setdefault(one.location.removesuffix(f"/{one.directory}"), []).append(one.location)
    for folder, locations in folders.items():
        reader = spark.read.format(described["provider"]).schema(schema).option("basePath", folder)
        yield reader.load(locations).select("*", F.col("_metadata.file_path").alias("__compacted_file"))
