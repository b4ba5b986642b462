"""The datasets a job may read, and those it may write."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerline.sources.catalog import partition_columns, read_table, write_table
from layerline.sources.once import append_once
from layerline.sources.paths import read_path, write_path
from layerline.sources.run import RunContext
from layerline.sources.specs import Dataset, resolve_path, resolve_table


class DatasetType(NamedTuple):
    """What a ``type`` in a spec stands for. Add an entry to ``DATASET_TYPES`` for a new one."""

    resolve: Callable[[str, Mapping[str, Any], RunContext, str], Dataset]
    read: Callable[[SparkSession, Dataset], DataFrame]
    write: Callable[[SparkSession, Dataset, DataFrame], None]
    # Columns that decide which directory or partition a row is written to.
    layout: Callable[[SparkSession, Dataset], tuple[str, ...]] = lambda spark, dataset: dataset.partition_by
    # For a type whose write cannot be observed from outside: writes, and returns the rows written.
    write_counted: Callable[[SparkSession, Dataset, DataFrame], int] | None = None


_FILES = DatasetType(resolve_path, read_path, write_path)
_TABLE = DatasetType(resolve_table, read_table, write_table, partition_columns)

DATASET_TYPES: dict[str, DatasetType] = {"path": _FILES, "table": _TABLE}


class DatasetGroup:
    """Resolved datasets of one kind, ``input`` or ``output``."""

    def __init__(
        self,
        spark: SparkSession,
        specs: Mapping[str, Mapping[str, Any]],
        run: RunContext,
        kind: str,
        environments: Mapping[str, Mapping[str, Any]] | None = None,
    ) -> None:
        self._spark, self._specs, self._run, self._kind = spark, specs, run, kind
        self._environments = environments or {}
        self._others: dict[str, DatasetGroup] = {}
        self.resolved = {name: _resolve(name, spec, run, kind) for name, spec in specs.items()}

    def __getitem__(self, name: str) -> Dataset:
        try:
            return self.resolved[name]
        except KeyError:
            raise KeyError(f"no {self._kind} dataset '{name}', only {sorted(self.resolved)}") from None

    def __call__(self, env: str) -> DatasetGroup:
        """The datasets in another environment, resolved on first use.

        An environment is a warehouse and a catalog that this session can reach,
        and where its datasets differ, ``datasets`` of its own. What it does not
        name it does not have: nothing falls back to the place of this run, so a
        write meant for elsewhere cannot land here. Endpoints and credentials
        stay with the Spark configuration.
        """
        if env == self._run.env:
            return self
        if env not in self._others:
            if env not in self._environments:
                raise KeyError(f"no environment '{env}', only {sorted(self._environments)}")
            there, now = self._environments[env], self._run
            run = RunContext(there.get("warehouse"), there.get("catalog"), env, now.ymd, now.hms)
            specs = there["datasets"].get(self._kind) or {} if "datasets" in there else self._specs
            here = {"warehouse": now.warehouse, "catalog": now.catalog, "datasets": {self._kind: self._specs}}
            group = DatasetGroup(self._spark, specs, run, self._kind, {**self._environments, now.env: here})
            for name, dataset in group.resolved.items():
                if dataset.type == "table" and not dataset.by_path and not run.catalog:
                    raise ValueError(f"dataset '{name}': environment '{env}' names no catalog for its table")
            self._others[env] = group
        return self._others[env]

    def read(self, name: str) -> DataFrame:
        if self._kind != "input":
            raise TypeError("output datasets are written, not read")
        return read_dataset(self._spark, self[name])

    def write(self, name: str, df: DataFrame, count_rows: bool = False) -> int | None:
        """Write ``df``; with ``count_rows``, return the rows written, counted by the write itself."""
        if self._kind != "output":
            raise TypeError("input datasets are read, not written")
        dataset = self[name]
        kind = _type_of(dataset)
        if df.isStreaming != (dataset.type == "stream"):
            raise ValueError(f"dataset '{name}': a stream is written to an output of type stream, and nothing else is")
        df = gathered(self._spark, dataset, df, kind.layout(self._spark, dataset) if dataset.rebalance else ())
        if dataset.once and not df.isStreaming:
            rows = append_once(self._spark, dataset, df, dataset.once)
            return rows if count_rows else None
        if not count_rows:
            kind.write(self._spark, dataset, df)
            return None
        if kind.write_counted:
            return kind.write_counted(self._spark, dataset, df)
        # After the shuffle: a lost executor makes Spark repeat tasks before a shuffle,
        # and their rows would be counted twice.
        written = Observation()
        kind.write(self._spark, dataset, df.observe(written, F.count(F.lit(1)).alias("rows")))
        return written.get["rows"]


def gathered(spark: SparkSession, dataset: Dataset, df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The rows brought together by the columns that decide their directory.

    Without this, every task writes a file for every value it meets. Adaptive
    execution splits a value that is too big for one task, so one hot day does not
    become one long task. Values that share a shuffle partition are split
    together, so there should be more of these than values.
    """
    if not columns:
        return df
    if spark.conf.get("spark.sql.adaptive.enabled").lower() != "true":
        raise ValueError(
            f"dataset '{dataset.name}': spark.sql.adaptive.enabled is off, so nothing would split a hot value of "
            f"{list(columns)}; turn it on or write with rebalance: false"
        )
    spread = () if dataset.rebalance is True else (dataset.rebalance,)
    return df.hint("rebalance", *spread, *columns)


def open_datasets(
    spark: SparkSession,
    specs: Mapping[str, Any],
    run: RunContext,
    environments: Mapping[str, Mapping[str, Any]] | None = None,
) -> tuple[DatasetGroup, DatasetGroup]:
    """Resolve ``{"input": {...}, "output": {...}}`` for one run. Bad specs fail here.

    This is the ``datasets`` section of a job config; its ``warehouse`` is for
    ``RunContext``. ``environments`` maps the name of another environment to its
    ``warehouse``, ``catalog`` and, where they differ, ``datasets``.
    """
    for env, there in (environments or {}).items():
        odd = sorted(there.keys() - {"warehouse", "catalog", "datasets"})
        if odd:
            raise ValueError(f"environment '{env}': 'warehouse', 'catalog' and 'datasets' are its keys, not {odd}")
    unknown = sorted(specs.keys() - {"input", "output", "warehouse"})
    if unknown:
        raise ValueError(f"dataset groups are 'input' and 'output', got {unknown}")
    inputs, outputs = (
        DatasetGroup(spark, specs.get(kind) or {}, run, kind, environments) for kind in ("input", "output")
    )
    return inputs, outputs


def read_dataset(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """Read a resolved dataset of either kind, as a job does with what it wrote."""
    return _type_of(dataset).read(spark, dataset)


def _resolve(name: str, spec: Any, run: RunContext, kind: str) -> Dataset:
    if not isinstance(spec, Mapping):
        raise ValueError(f"dataset '{name}': a spec is a mapping, not a {type(spec).__name__}")
    if not spec.get("type"):
        raise ValueError(f"dataset '{name}': no 'type' in the spec")
    if spec["type"] not in DATASET_TYPES:
        raise ValueError(f"dataset '{name}': type {spec['type']!r} is none of {sorted(DATASET_TYPES)}")
    return DATASET_TYPES[spec["type"]].resolve(name, spec, run, kind)


def _type_of(dataset: Dataset) -> DatasetType:
    # A table stored at a path is read and written as files.
    if dataset.type == "table" and dataset.by_path:
        return _FILES
    return DATASET_TYPES[dataset.type]
