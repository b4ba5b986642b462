"""Dataset specs: plain dicts turned into checked, resolved :class:`Dataset` values.

Everything that can be wrong with a spec is reported here, before Spark reads
or writes a row.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from layerline.sources.run import RunContext

PATH_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")
TABLE_MODES = ("append", "overwrite_partitions")


@dataclass(frozen=True)
class Dataset:
    name: str
    type: str
    location: str
    by_path: bool = True
    format: str | None = None
    mode: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    # Column types for the reader. Needed where files do not carry them (csv, json) and
    # for partition columns: Spark would infer ymd as a date and hms=000101 as the int 101.
    schema: str | None = None
    # Gather the rows of a partition value before a partitioned write (see groups.py).
    # A number is how many shuffle partitions to spread the values over.
    rebalance: bool | int = True
    # What an append that may be repeated is known by (see once.py).
    once: str | None = None
    # Overwrite by swapping directories (see swap.py).
    swap: bool = False
    # The spec as it was given.
    spec: Mapping[str, Any] = field(default_factory=dict)


def resolve_path(name: str, spec: Mapping[str, Any], run: RunContext, kind: str) -> Dataset:
    if not spec.get("path"):
        raise ValueError(f"dataset '{name}': no 'path' in the spec")
    return resolve_files(name, spec, run, kind, default_format="parquet")


def resolve_table(name: str, spec: Mapping[str, Any], run: RunContext, kind: str) -> Dataset:
    """``table`` names a catalog table; ``path`` alone is a table stored at a location."""
    if not spec.get("table"):
        if not spec.get("path"):
            raise ValueError(f"dataset '{name}': neither 'table' nor 'path' in the spec")
        return resolve_files(name, spec, run, kind, default_format="iceberg")

    # The table's own definition settles these. Taking them here and not using them would mislead.
    fixed = sorted({"format", "options", "partition_by", "schema"} & spec.keys())
    if fixed:
        raise ValueError(f"dataset '{name}': {fixed} come from the definition of a catalog table")
    mode = spec.get("mode")
    if kind == "output" and mode not in TABLE_MODES:
        raise ValueError(f"dataset '{name}': table write mode must be one of {TABLE_MODES}, got {mode!r}")
    return Dataset(
        name=name,
        type="table",
        location=run.table_name(str(spec["table"])),
        by_path=False,
        mode=mode,
        rebalance=_rebalance(name, spec),
        once=_once(name, spec, run, kind, mode),
        spec=spec,
    )


def resolve_files(name: str, spec: Mapping[str, Any], run: RunContext, kind: str, default_format: str) -> Dataset:
    """A dataset that is read and written by format, options and, where it has one, location."""
    mode = str(spec.get("mode", "overwrite"))
    if kind == "output" and mode not in PATH_MODES:
        raise ValueError(f"dataset '{name}': path write mode must be one of {PATH_MODES}, got {mode!r}")
    options = spec.get("options") or {}
    if not isinstance(options, Mapping):
        raise ValueError(f"dataset '{name}': options are a mapping, not a {type(options).__name__}")
    partition_by = spec.get("partition_by") or ()
    if isinstance(partition_by, str):
        partition_by = (partition_by,)
    dynamic = any(key.lower() == "partitionoverwritemode" for key in options)
    if spec.get("swap") and (mode != "overwrite" or dynamic):
        raise ValueError(f"dataset '{name}': swap is for writes that overwrite a whole location")
    return Dataset(
        name=name,
        type=str(spec["type"]),
        location=run.location(str(spec["path"]), name) if spec.get("path") else "",
        format=str(spec.get("format", default_format)),
        mode=mode,
        options={str(key): _option_text(value) for key, value in options.items()},
        partition_by=tuple(partition_by),
        schema=spec.get("schema"),
        rebalance=_rebalance(name, spec),
        once=_once(name, spec, run, kind, mode),
        swap=bool(spec.get("swap")),
        spec=spec,
    )


def _once(name: str, spec: Mapping[str, Any], run: RunContext, kind: str, mode: str | None) -> str | None:
    """The key of an append that may be repeated. Streams know their batches themselves and say true."""
    once = spec.get("once")
    if not once or kind != "output":
        return None
    if mode != "append":
        raise ValueError(f"dataset '{name}': only what is appended can be there twice; 'once' does not go with {mode}")
    if spec["type"] == "stream":
        return str(once)
    if not isinstance(once, str):
        raise ValueError(f"dataset '{name}': once is a text that names the run, such as 'orders-{{ymd}}-{{hms}}'")
    return run.fill(once, name)


def _rebalance(name: str, spec: Mapping[str, Any]) -> bool | int:
    rebalance = spec.get("rebalance", True)
    if not isinstance(rebalance, int) or rebalance < 0:
        raise ValueError(f"dataset '{name}': rebalance is true, false or a number, not {rebalance!r}")
    return rebalance


def _option_text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)
