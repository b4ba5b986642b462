"""Datasets that are read as streams: each run takes what arrived since the last, and nothing twice."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from hashlib import sha256
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from layerline.sources.catalog import partition_columns, quoted
from layerline.sources.groups import DATASET_TYPES, DatasetType
from layerline.sources.once import append_once, forget_before, location_of
from layerline.sources.run import RunContext
from layerline.sources.specs import Dataset, resolve_files, resolve_table
from layerline.streaming.archive import Generation, archive_taken, open_generation
from layerline.streaming.counts import BatchRows

# Spark skips files that are older, by their modification time, than the newest it has
# seen less a week. Copies and restores keep old times, so no age is too old here. The
# price is that a log of files taken never shrinks by itself: some hundred bytes per
# file. An output with an ``archive`` begins a new log instead (see archive.py).
_AGE, _ANY_AGE = "maxFileAge", "36500d"
# Files that one micro-batch may write for one value of the partition columns.
_FILES_PER_VALUE = 8
# Places the library gives to itself; neither reader nor writer of files sees them.
_CHECKPOINT, _ARCHIVE = "checkpointLocation", "archiveLocation"
# Files after which a log is long enough, where the output has an archive.
_LOG_FILES = 100_000


def resolve_stream(name: str, spec: Mapping[str, Any], run: RunContext, kind: str) -> Dataset:
    """Inputs have a ``path`` and a ``schema``, or a ``format`` such as kafka and its options.

    ``batch_bytes`` of an input of files is how much one micro-batch takes, so that
    a backlog is committed in steps; without it a run is one micro-batch.

    Outputs have a ``checkpoint``, which records what was taken, and a ``table``, or a
    ``path`` next to it. A table is appended to with a record of each micro-batch, kept
    with the table, so that a repeated one changes nothing; a path too with ``once: true``,
    and otherwise by Spark's own sink. With an ``archive``, files taken are moved there, and
    the log of them begins anew once it has ``log_files`` names.
    """
    if kind == "input":
        if not spec.get("format") and not (spec.get("path") and spec.get("schema")):
            raise ValueError(f"dataset '{name}': a stream of files has a 'path' and a 'schema'")
        if "batch_bytes" in spec and (not spec.get("path") or not isinstance(spec["batch_bytes"], int)):
            raise ValueError(f"dataset '{name}': batch_bytes is a number of bytes, for a stream of files")
        return resolve_files(name, spec, run, kind, default_format="parquet")
    if not ((spec.get("path") or spec.get("table")) and spec.get("checkpoint")):
        raise ValueError(f"dataset '{name}': a stream is written to a 'path' or a 'table' and needs a 'checkpoint'")
    if spec.get("mode", "append") != "append":
        raise ValueError(f"dataset '{name}': streams append, they cannot {spec['mode']}")
    if spec.get("table"):
        # Known to the library only; the definition of the table settles the rest.
        target = replace(resolve_table(name, {**spec, "mode": "append", "once": True}, run, kind), type="stream")
    else:
        target = resolve_files(name, {**spec, "mode": "append"}, run, kind, default_format="parquet")
    options = {**target.options, _CHECKPOINT: run.location(spec["checkpoint"], name)}
    if spec.get("archive"):
        if not target.once:
            raise ValueError(f"dataset '{name}': an archive goes with a 'table' or with once: true")
        options[_ARCHIVE] = run.location(spec["archive"], name)
    return replace(target, options=options)


def read_stream(spark: SparkSession, dataset: Dataset) -> DataFrame:
    reader = spark.readStream.format(dataset.format).options(**dataset.options)
    if dataset.schema:
        reader = reader.schema(dataset.schema)
    if not dataset.location:
        return reader.load()
    if _AGE.lower() not in {option.lower() for option in dataset.options}:
        reader = reader.option(_AGE, _ANY_AGE)
    if "batch_bytes" in dataset.spec:
        reader = reader.option("maxBytesPerTrigger", dataset.spec["batch_bytes"])
    return reader.load(dataset.location)


def write_stream(spark: SparkSession, dataset: Dataset, df: DataFrame) -> None:
    """Append what there is and stop."""
    if dataset.once:
        _append_batches(spark, dataset, df)
    else:
        _started(_sink(dataset, _spread(df, dataset, dataset.partition_by)), dataset.location)


def write_stream_counted(spark: SparkSession, dataset: Dataset, df: DataFrame) -> int:
    """As ``write_stream``; the rows of all micro-batches that this run committed."""
    if dataset.once:
        return _append_batches(spark, dataset, df)
    # Above the shuffle, as for a batch: tasks below it may run more than once.
    with BatchRows(spark) as rows:
        written = _spread(df, dataset, dataset.partition_by).observe(rows.name, F.count(F.lit(1)).alias("rows"))
        return rows.of(_started(_sink(dataset, written), dataset.location))


def _append_batches(spark: SparkSession, dataset: Dataset, df: DataFrame) -> int:
    """Micro-batches by key: a batch that is repeated, since its run ended before it was committed, adds nothing.

    Its rows count for the run that commits it, which is the one that returns.
    """
    files = {name: value for name, value in dataset.options.items() if name not in (_CHECKPOINT, _ARCHIVE)}
    target = replace(dataset, type="path" if dataset.by_path else "table", options=files)
    checkpoint, archive = dataset.options[_CHECKPOINT], dataset.options.get(_ARCHIVE)
    generation = open_generation(spark, checkpoint) if archive else Generation(0, checkpoint)
    stream = sha256(checkpoint.encode()).hexdigest()[:16]
    location, rows = location_of(spark, target), []

    def append(batch: DataFrame, number: int) -> None:
        key = f"{stream}-{generation.number:06d}-{number:012d}"
        # A batch belongs to a session of its own, where its rows can be named in a statement.
        rows.append(append_once(batch.sparkSession, target, batch, key))
        forget_before(spark, location, stream, key)

    columns = dataset.partition_by if dataset.by_path else partition_columns(spark, target)
    writer = _spread(df, dataset, columns).writeStream.outputMode("append").foreachBatch(append)
    _started(writer.option(_CHECKPOINT, generation.checkpoint), None)
    if not dataset.by_path:
        # Each batch had a session of its own; this one may hold an older list of the table's files.
        spark.catalog.refreshTable(quoted(dataset.location))
    if archive:
        archive_taken(spark, checkpoint, generation, archive, dataset.spec.get("log_files", _LOG_FILES))
    return sum(rows)


def _spread(df: DataFrame, dataset: Dataset, columns: tuple[str, ...]) -> DataFrame:
    """Adaptive execution does not split the partitions of a stream, so a value's rows
    are dealt to a fixed number of tasks: ``rebalance`` of the spec, 8 by default.
    Which task is a matter of the row's content, so a repeated task writes the same.
    """
    if not (columns and dataset.rebalance):
        return df
    width = _FILES_PER_VALUE if dataset.rebalance is True else dataset.rebalance
    hashed = [F.col(f"`{one.name}`") for one in df.schema if "map<" not in one.dataType.simpleString()]
    return df.repartition(*columns, F.pmod(F.xxhash64(*hashed), F.lit(width)))


def _sink(dataset: Dataset, df: DataFrame) -> DataStreamWriter:
    writer = df.writeStream.format(dataset.format).outputMode("append").options(**dataset.options)
    return writer.partitionBy(*dataset.partition_by) if dataset.partition_by else writer


def _started(writer: DataStreamWriter, location: str | None):
    query = writer.trigger(availableNow=True).start(location)
    query.awaitTermination()
    return query


# Gathered by write_stream itself.
DATASET_TYPES["stream"] = DatasetType(
    resolve_stream, read_stream, write_stream, lambda spark, dataset: (), write_stream_counted
)
