"""Appends that may be repeated: what a key stands for is there once, however often it is written.

The rows of a key are written aside, in a hidden folder of the dataset itself, and
then moved in file by file. The folder's name says how far that came:

    <key>.begun   being written; of no use after a failure
    <key>.ready   written whole, files on their way
    <key>.done    all files are in place; how many rows they hold

A repeated append finds ``done`` and adds nothing, or finds ``ready`` and moves what is
left, or begins anew. Files have names of their own, so none is moved in twice. As with
Spark's own commit, readers may see some files before the others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from hashlib import sha256
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerline.sources.catalog import (
    check_same_columns,
    describe_file_table,
    describe_partition,
    is_file_table,
    quoted,
    quoted_part,
    text_literal,
    write_table,
)
from layerline.sources.folders import (
    data_files,
    folder_entries,
    folder_exists,
    leave_mark,
    move,
    remove_folder,
)
from layerline.sources.paths import write_path
from layerline.sources.run import SESSION_CATALOG
from layerline.sources.specs import Dataset

RECORDS = ".layerline"
_ROWS = "_rows="
#: How Spark names the directory of rows whose partition column is NULL.
_NULL = "__HIVE_DEFAULT_PARTITION__"


def append_once(spark: SparkSession, dataset: Dataset, df: DataFrame, key: str) -> int:
    """Append ``df`` under ``key`` and return how many rows are there under it.

    Where the key is there already, ``df`` is not evaluated. For files and for tables of
    files in the session catalog, with one writer at a time.
    """
    if dataset.by_path:
        location, place, stage = dataset.location, _below(dataset.location), _stage_files
    else:
        if not is_file_table(spark, dataset.location):
            raise ValueError(
                f"dataset '{dataset.name}': {dataset.location} is not made of files that Spark writes; "
                "use overwrite_partitions where a write may be repeated"
            )
        check_same_columns(spark, dataset, df)
        location = describe_file_table(spark, dataset.location)["location"]
        place, stage = _partition_places(spark, dataset.location, location), _stage_for_table
    begun, ready, done = (f"{_record(location, key)}.{state}" for state in ("begun", "ready", "done"))
    if not folder_exists(spark, done):
        if not folder_exists(spark, ready):
            remove_folder(spark, begun)
            written = Observation()
            stage(spark, dataset, df.observe(written, F.count(F.lit(1)).alias("rows")), begun)
            leave_mark(spark, f"{begun}/{_ROWS}{written.get['rows']}")
            move(spark, begun, ready)
        publish(spark, ready, place)
        move(spark, ready, done)
        if not dataset.by_path:
            spark.catalog.refreshTable(quoted(dataset.location))
    return next(int(name.removeprefix(_ROWS)) for name in folder_entries(spark, done) if name.startswith(_ROWS))


def publish(spark: SparkSession, ready: str, place: Callable[[str], str]) -> None:
    """Move what is left in ``ready``; ``place`` says where the files of a partition directory belong."""
    places: dict[str, str] = {}
    for file in data_files(spark, ready):
        directory, _, name = file.rpartition("/")
        if directory not in places:
            places[directory] = place(directory)
        move(spark, f"{ready}/{file}", f"{places[directory]}/{name}")


def forget_before(spark: SparkSession, location: str, stream: str, key: str) -> None:
    """Drop the records of a stream's earlier keys, none of which can be asked for again."""
    for name in folder_entries(spark, f"{location}/{RECORDS}"):
        if name.startswith(quote(stream, safe="")) and name < quote(key, safe="") and name.endswith(".done"):
            remove_folder(spark, f"{location}/{RECORDS}/{name}")


def location_of(spark: SparkSession, dataset: Dataset) -> str:
    return dataset.location if dataset.by_path else describe_file_table(spark, dataset.location)["location"]


def partition_values(directory: str) -> dict[str, str | None]:
    """``day=2024-01-02/kind=a%2Fb`` as columns and values."""
    parts = (part.partition("=") for part in directory.split("/") if part)
    return {unquote(name): None if value == _NULL else unquote(value) for name, _, value in parts}


def partition_clause(values: dict[str, str | None]) -> str:
    pairs = (f"{quoted_part(name)} = {'NULL' if value is None else text_literal(value)}" for name, value in values.items())
    return f"PARTITION ({', '.join(pairs)})"


def _record(location: str, key: str) -> str:
    if not key:
        raise ValueError("an append that may be repeated needs a key")
    return f"{location}/{RECORDS}/{quote(key, safe='')}"


def _below(location: str) -> Callable[[str], str]:
    return lambda directory: f"{location}/{directory}".rstrip("/")


def _partition_places(spark: SparkSession, table: str, location: str) -> Callable[[str], str]:
    """Where the table keeps a partition; one that it lacks is added."""

    def place(directory: str) -> str:
        if not directory:
            return location
        clause = partition_clause(partition_values(directory))
        try:
            return describe_partition(spark, table, clause)["location"]
        except AnalysisException:
            spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {clause}")
            return describe_partition(spark, table, clause)["location"]

    return place


def _stage_files(spark: SparkSession, dataset: Dataset, df: DataFrame, folder: str) -> None:
    write_path(spark, replace(dataset, location=folder, mode="error"), df)


def _stage_for_table(spark: SparkSession, dataset: Dataset, df: DataFrame, folder: str) -> None:
    """Through a table like it, so that types, format and layout are those of an append to it."""
    aside = f"{dataset.location}__once_{sha256(folder.encode()).hexdigest()[:12]}"
    spark.sql(f"DROP TABLE IF EXISTS {quoted(aside)}")
    # This statement always speaks to the session catalog and does not take its name.
    new, like = (quoted(name.removeprefix(f"{SESSION_CATALOG}.")) for name in (aside, dataset.location))
    spark.sql(f"CREATE TABLE {new} LIKE {like} LOCATION {text_literal(folder)}")
    try:
        write_table(spark, replace(dataset, location=aside, mode="append"), df)
    finally:
        # The files stay: a table with a location does not own them.
        spark.sql(f"DROP TABLE IF EXISTS {quoted(aside)}")
