"""The coordinates of one run: where its data lives and which day and time it covers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from typing import Any

SESSION_CATALOG = "spark_catalog"


@dataclass(frozen=True)
class RunContext:
    """``ymd`` is ``YYYY-MM-DD`` and ``hms`` is ``HHMMSS``; maintenance work has neither."""

    warehouse: str | None = None
    catalog: str | None = None
    env: str = "local"
    ymd: str | None = None
    hms: str | None = None

    def __post_init__(self) -> None:
        _check_written_as(self.ymd, "%Y-%m-%d", "a day written as YYYY-MM-DD")
        _check_written_as(self.hms, "%H%M%S", "a time written as HHMMSS")

    @classmethod
    def from_config(
        cls, config: Mapping[str, Any], env: str, ymd: str | None = None, hms: str | None = None
    ) -> RunContext:
        """From a loaded job config: ``datasets.warehouse`` and ``catalog.name`` (or ``catalog.default``)."""
        catalog = config.get("catalog") or {}
        return cls(
            warehouse=(config.get("datasets") or {}).get("warehouse"),
            catalog=catalog.get("name") or catalog.get("default"),
            env=env,
            ymd=ymd,
            hms=hms,
        )

    def require_batch(self) -> None:
        """Batch jobs are tied to one day and time."""
        if self.ymd is None or self.hms is None:
            raise ValueError("a batch job needs both ymd and hms")

    def fill(self, template: str, owner: str) -> str:
        """Replace ``{ymd}``, ``{hms}`` and ``{env}``; anything else is an error."""
        values = {"ymd": self.ymd, "hms": self.hms, "env": self.env}
        known = {key: value for key, value in values.items() if value is not None}
        try:
            return template.format_map(known)
        except KeyError as error:
            raise ValueError(
                f"dataset '{owner}': no value for {{{error.args[0]}}} in {template!r} (available: {sorted(known)})"
            ) from None
        except (IndexError, ValueError) as error:
            raise ValueError(f"dataset '{owner}': bad template {template!r}: {error}") from None

    def location(self, path: str, owner: str = "") -> str:
        if not self.warehouse:
            raise ValueError(f"dataset '{owner}': the run has no warehouse for its path")
        return f"{self.warehouse.rstrip('/')}/{self.fill(path, owner).lstrip('/')}"

    def table_name(self, table: str) -> str:
        """Put the catalog in front, once.

        The session catalog takes one namespace level only, so there
        ``layer.domain.table`` becomes ``layer__domain.table``. Names that hold
        ``__`` themselves are refused, which keeps the mapping one-to-one.
        """
        if not self.catalog:
            return table
        name = table.removeprefix(f"{self.catalog}.")
        if self.catalog == SESSION_CATALOG:
            *namespace, last = name.split(".")
            if any("__" in part for part in namespace):
                raise ValueError(f"'__' is reserved in session catalog namespaces: {table!r}")
            name = f"{'__'.join(namespace)}.{last}" if namespace else last
        return f"{self.catalog}.{name}"


def _check_written_as(value: str | None, layout: str, wanted: str) -> None:
    if value is None:
        return
    try:
        # Written back, so that 2024-1-2 fails: it would name another partition.
        if datetime.strptime(value, layout).strftime(layout) == value:
            return
    except ValueError:
        pass
    raise ValueError(f"{value!r} is not {wanted}")
