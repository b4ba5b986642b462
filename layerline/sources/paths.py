"""Datasets stored as files at a location."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerline.sources.folders import folder_exists
from layerline.sources.specs import Dataset
from layerline.sources.swap import recover, swapped

_OVERWRITE_MODE = "partitionOverwriteMode"
_STREAM_LOG = "_spark_metadata"


def read_path(spark: SparkSession, dataset: Dataset) -> DataFrame:
    if dataset.swap:
        recover(spark, dataset.location)
    reader = spark.read.format(dataset.format).options(**dataset.options)
    if dataset.schema:
        reader = reader.schema(dataset.schema)
    return reader.load(dataset.location)


def write_path(spark: SparkSession, dataset: Dataset, df: DataFrame) -> None:
    if dataset.mode == "append" and folder_exists(spark, f"{dataset.location}/{_STREAM_LOG}"):
        # Readers of the folder go by the stream's log, so they would never see these files.
        raise ValueError(f"dataset '{dataset.name}': {dataset.location} belongs to a stream; append to it with one")
    writer = df.write.format(dataset.format).mode(dataset.mode).options(**dataset.options)
    if dataset.partition_by:
        writer = writer.partitionBy(*dataset.partition_by)
        said = {key.lower() for key in dataset.options}
        if dataset.mode == "overwrite" and _OVERWRITE_MODE.lower() not in said:
            # Overwrite means the whole location, also in a session set to dynamic overwrite.
            writer = writer.option(_OVERWRITE_MODE, "static")
    if not dataset.swap:
        return writer.save(dataset.location)
    with swapped(spark, dataset.location) as aside:
        writer.save(aside)
