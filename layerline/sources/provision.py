"""Creating, listing and dropping catalog tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import takewhile
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from layerline.sources.catalog import (
    describe_file_table,
    is_file_table,
    on_session_catalog,
    quoted,
    quoted_part,
    table_format,
    text_literal,
)
from layerline.sources.folders import folder_exists
from layerline.sources.run import RunContext

LAYERS = ("raw", "refined", "mart")
#: Formats whose files may lack a column that their table has; it reads as NULL there.
ADDABLE = ("parquet", "orc", "json")


@dataclass(frozen=True, order=True)
class TableDefinition:
    """One CREATE TABLE statement, or several statements that are run in order.

    ``${name}`` (the full table name, quoted), ``${format}``, ``${warehouse}``,
    ``${layer}``, ``${domain}`` and ``${table}`` are filled in, the last four as
    they stand in a quoted text; other ``$`` text stays as it is. All statements
    run whenever the table is applied, so write them so that they may be repeated.
    """

    layer: str
    domain: str
    table: str
    ddl: str | tuple[str, ...]

    def __post_init__(self) -> None:
        _check_layer(self.layer)

    @property
    def dotted(self) -> str:
        return f"{self.layer}.{self.domain}.{self.table}"

    def statements(self, run: RunContext, made_of: str) -> list[str]:
        inside = {
            "warehouse": (run.warehouse or "").rstrip("/"),
            "layer": self.layer,
            "domain": self.domain,
            "table": self.table,
        }
        values = {key: text_literal(value)[1:-1] for key, value in inside.items()}
        values |= {"name": quoted(run.table_name(self.dotted)), "format": made_of}
        texts = (self.ddl,) if isinstance(self.ddl, str) else self.ddl
        return [Template(one).safe_substitute(values) for one in texts]


def select_tables(
    definitions: Sequence[TableDefinition],
    layer: str | None = None,
    domain: str | None = None,
    table: str | None = None,
) -> list[TableDefinition]:
    """One table, a domain, a layer or everything, in name order."""
    if layer:
        _check_layer(layer)
    if table and not domain:
        raise ValueError("a table needs its domain")
    if domain and not layer:
        raise ValueError("a domain needs its layer")
    chosen = sorted(
        one
        for one in definitions
        if (not layer or one.layer == layer)
        and (not domain or one.domain == domain)
        and (not table or one.table == table)
    )
    if not chosen:
        raise FileNotFoundError(f"no table definition for {'.'.join(filter(None, (layer, domain, table))) or 'any'}")
    return chosen


def create_tables(
    spark: SparkSession,
    definitions: Sequence[TableDefinition],
    run: RunContext,
    layer: str | None = None,
    domain: str | None = None,
    table: str | None = None,
) -> list[str]:
    """Create what is absent of the selected tables; return their full names."""
    return [_create(spark, one, run) for one in select_tables(definitions, layer, domain, table)]


@dataclass(frozen=True)
class Drift:
    """How a table differs from its definition: columns it lacks, and what cannot be made good by adding columns."""

    added: tuple[StructField, ...]
    refused: tuple[str, ...]


def table_drift(spark: SparkSession, definition: TableDefinition, run: RunContext) -> Drift:
    """Compare the definition, as Spark's own parser reads it, with what the catalog holds. No statement of it is run.

    Columns are compared by name and type, then the partition columns and the format. Order,
    nullability and comments are not: writes match columns by name, and files do not enforce the rest.
    """
    name = run.table_name(definition.dotted)
    statements = definition.statements(run, table_format(spark, run))
    parser = spark._jsparkSession.sessionState().sqlParser()
    plan = parser.parsePlan(statements[0])
    if len(statements) > 1 or plan.getClass().getSimpleName() != "CreateTable":
        raise ValueError(f"{definition.dotted}: only a definition of one CREATE TABLE with columns can be compared")
    wanted = {field.name.lower(): field for field in StructType.fromJson(json.loads(plan.tableSchema().json()))}
    rows = spark.sql(f"DESCRIBE TABLE {quoted(name)}").collect()
    # Partition columns are told again below a heading.
    there = {row.col_name.lower(): row.data_type for row in takewhile(lambda row: not _is_heading(row.col_name), rows)}
    refused = [f"column {one} is {there[one]}, not {wanted[one].dataType.simpleString()}"
               for one in wanted.keys() & there.keys() if there[one] != wanted[one].dataType.simpleString()]
    refused += [f"column {one} is not in the definition" for one in there.keys() - wanted.keys()]
    added = [field for one, field in wanted.items() if one not in there]
    transforms = plan.partitioning()
    by = [transforms.apply(i).describe().strip("`").lower() for i in range(transforms.size())]
    refused += [f"partition column {one.name} is not there" for one in added if one.name.lower() in by]
    if is_file_table(spark, name):
        described = describe_file_table(spark, name)
        found = [one.lower() for one in described.get("partition_columns", ())]
        if found != by:
            refused.append(f"partitioned by {found}, not {by}")
        provider = plan.tableSpec().provider()
        if provider.isDefined() and provider.get().lower() != described["provider"].lower():
            refused.append(f"made of {described['provider']}, not {provider.get()}")
        if added and described["provider"].lower() not in ADDABLE:
            refused.append(f"columns cannot be added to files of {described['provider']}")
    return Drift(tuple(added), tuple(sorted(refused)))


def align_tables(
    spark: SparkSession,
    definitions: Sequence[TableDefinition],
    run: RunContext,
    layer: str | None = None,
    domain: str | None = None,
    table: str | None = None,
) -> dict[str, list[str]]:
    """Create what is absent and add the columns that tables lack; return the columns added, by full name.

    Every selected table is compared first. If one of them differs in any other way, nothing is changed.
    """
    chosen = select_tables(definitions, layer, domain, table)
    drifts = {
        one: table_drift(spark, one, run)
        for one in chosen
        if spark.catalog.tableExists(quoted(run.table_name(one.dotted)))
    }
    refused = [f"{one.dotted}: {reason}" for one, drift in drifts.items() for reason in drift.refused]
    if refused:
        raise ValueError("tables differ from their definitions, nothing was changed: " + "; ".join(refused))
    changed = {}
    for one in chosen:
        name = _create(spark, one, run) if one not in drifts else run.table_name(one.dotted)
        added = drifts[one].added if one in drifts else ()
        if added:
            columns = ", ".join(_column(field) for field in added)
            spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({columns})")
        changed[name] = [field.name for field in added]
    return changed


def _column(field: StructField) -> str:
    comment = field.metadata.get("comment")
    written = f"{quoted_part(field.name)} {field.dataType.simpleString()}"
    return written + (f" COMMENT {text_literal(comment)}" if comment else "")


def _is_heading(name: str) -> bool:
    return not name or name.startswith("#")


def drop_table(spark: SparkSession, run: RunContext, layer: str, domain: str, table: str) -> None:
    _check_layer(layer)
    if not (domain and table):
        raise ValueError("dropping needs layer, domain and table")
    spark.sql(f"DROP TABLE IF EXISTS {quoted(run.table_name(f'{layer}.{domain}.{table}'))}")


def list_tables(spark: SparkSession, run: RunContext, layer: str, domain: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {quoted(_namespace(run, layer, domain))}")


def _create(spark: SparkSession, definition: TableDefinition, run: RunContext) -> str:
    name = run.table_name(definition.dotted)
    for namespace in _namespaces(run, definition, on_session_catalog(spark, name)):
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    absent = not spark.catalog.tableExists(quoted(name))
    for statement in definition.statements(run, table_format(spark, run)):
        spark.sql(statement)
    if absent and is_file_table(spark, name):
        described = describe_file_table(spark, name)
        if described.get("partition_columns") and folder_exists(spark, described["location"]):
            # A file table made over existing directories shows no rows until they are registered.
            spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")
    return name


def _namespaces(run: RunContext, definition: TableDefinition, one_level: bool) -> list[str]:
    inner = quoted(_namespace(run, definition.layer, definition.domain))
    if not one_level:
        return [quoted(_namespace(run, definition.layer)), inner]
    if not run.warehouse:
        return [inner]
    # The default place of a session catalog namespace is a folder of the driver's machine.
    return [f"{inner} LOCATION {text_literal(run.location(f'{definition.layer}/{definition.domain}'))}"]


def _namespace(run: RunContext, *levels: str) -> str:
    # Built like a table name, so that definitions and namespaces cannot disagree.
    return run.table_name(".".join((*levels, "_"))).removesuffix("._")


def _check_layer(layer: str) -> None:
    if layer not in LAYERS:
        raise ValueError(f"{layer!r} is not a layer; these are {LAYERS}")
