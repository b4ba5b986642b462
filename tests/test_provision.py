from __future__ import annotations

from unittest.mock import MagicMock
from uuid import uuid4

import pytest
from pyspark.errors import AnalysisException

from layerline import RunContext
from layerline.sources.catalog import quoted
from layerline.sources.provision import (
    TableDefinition,
    align_tables,
    create_tables,
    drop_table,
    list_tables,
    select_tables,
    table_drift,
)
from tests.conftest import rows

DDL = "CREATE TABLE IF NOT EXISTS ${name} (id BIGINT) USING ${format} LOCATION '${warehouse}/${layer}/${domain}/${table}'"
NAMES = [("refined", "sample", "orders"), ("raw", "sample", "orders"), ("refined", "other", "b"), ("refined", "other", "a")]
DEFINITIONS = [TableDefinition(*name, DDL) for name in NAMES]


def names(definitions):
    return [one.dotted for one in definitions]


def test_scopes_in_name_order():
    assert names(select_tables(DEFINITIONS)) == [
        "raw.sample.orders",
        "refined.other.a",
        "refined.other.b",
        "refined.sample.orders",
    ]
    assert names(select_tables(DEFINITIONS, "raw")) == ["raw.sample.orders"]
    assert names(select_tables(DEFINITIONS, "refined", "other")) == ["refined.other.a", "refined.other.b"]
    assert names(select_tables(DEFINITIONS, "refined", "other", "b")) == ["refined.other.b"]


@pytest.mark.parametrize(
    ("scope", "error"),
    [
        (("bronze",), ValueError),
        ((None, "sample"), ValueError),
        (("raw", None, "orders"), ValueError),
        (("raw", "sample", "nope"), FileNotFoundError),
        (("mart",), FileNotFoundError),
    ],
)
def test_bad_scopes(scope, error):
    with pytest.raises(error):
        select_tables(DEFINITIONS, *scope)


def test_definitions_name_a_layer():
    with pytest.raises(ValueError, match="is not a layer"):
        TableDefinition("bronze", "sample", "orders", DDL)


def test_statement_is_filled_in_and_unknown_names_stay():
    run = RunContext(warehouse="s3a://depot/", catalog="lake")
    one = TableDefinition("refined", "sample", "orders", DDL + " COMMENT '$who ${what}; $$'")
    assert one.statements(run, "iceberg") == [
        "CREATE TABLE IF NOT EXISTS `lake`.`refined`.`sample`.`orders` (id BIGINT) USING iceberg "
        "LOCATION 's3a://depot/refined/sample/orders' COMMENT '$who ${what}; $'"
    ]


def test_statements_for_another_catalog():
    """There is none here to run them on, so this checks the statements only."""
    spark = MagicMock()
    spark.conf.get = lambda key, default=None: {"spark.sql.catalog.lake": "org.example.Catalog"}.get(key, default)
    run = RunContext(warehouse="s3a://depot", catalog="lake")
    assert create_tables(spark, DEFINITIONS, run, "refined", "sample", "orders") == ["lake.refined.sample.orders"]
    drop_table(spark, run, "refined", "sample", "orders")
    list_tables(spark, run, "refined", "sample")
    assert [call.args[0] for call in spark.sql.call_args_list] == [
        "CREATE NAMESPACE IF NOT EXISTS `lake`.`refined`",
        "CREATE NAMESPACE IF NOT EXISTS `lake`.`refined`.`sample`",
        "CREATE TABLE IF NOT EXISTS `lake`.`refined`.`sample`.`orders` (id BIGINT) USING iceberg "
        "LOCATION 's3a://depot/refined/sample/orders'",
        "DROP TABLE IF EXISTS `lake`.`refined`.`sample`.`orders`",
        "SHOW TABLES IN `lake`.`refined`.`sample`",
    ]


def test_several_statements(spark, table_run):
    domain = f"d{uuid4().hex}"
    grow = "ALTER TABLE ${name} SET TBLPROPERTIES ('kept' = '${domain}')"
    definition = TableDefinition("refined", domain, "orders", (DDL, grow))
    for _ in range(2):
        (name,) = create_tables(spark, [definition], table_run)
    assert spark.sql(f"SHOW TBLPROPERTIES {name} ('kept')").first().value == domain


def test_a_quote_in_the_warehouse(spark, table_run, tmp_path):
    run = RunContext(warehouse=f"file://{tmp_path}/it's here", catalog=table_run.catalog)
    definition = TableDefinition("refined", f"d{uuid4().hex}", "orders", DDL)
    (name,) = create_tables(spark, [definition], run)
    spark.sql(f"INSERT INTO {name} VALUES (7)")
    assert rows(spark.read.parquet(f"{tmp_path}/it's here/refined/{definition.domain}/orders")) == [(7,)]


def test_hyphens_are_for_catalogs_that_take_them(spark, table_run):
    """Quoted they reach the catalog whole; Spark's own takes letters, digits and _ only and says so."""
    assert quoted("hub.re`fined.a-b") == "`hub`.`re``fined`.`a-b`"
    with pytest.raises(AnalysisException, match="is not a valid name"):
        create_tables(spark, [TableDefinition("refined", "a-b", "orders", DDL)], table_run)


def test_create_list_drop(spark, table_run):
    domain = f"d{uuid4().hex}"
    definition = TableDefinition("refined", domain, "orders", DDL)
    created = create_tables(spark, [definition], table_run, "refined", domain, "orders")
    assert created == [f"spark_catalog.refined__{domain}.orders"]
    assert [row.tableName for row in list_tables(spark, table_run, "refined", domain).collect()] == ["orders"]

    spark.sql(f"INSERT INTO {created[0]} VALUES (7)")
    assert create_tables(spark, [definition], table_run) == created
    assert rows(spark.table(created[0])) == [(7,)]

    drop_table(spark, table_run, "refined", domain, "orders")
    drop_table(spark, table_run, "refined", domain, "orders")
    assert list_tables(spark, table_run, "refined", domain).count() == 0
    assert rows(spark.read.parquet(table_run.location(f"refined/{domain}/orders"))) == [(7,)]


def test_partitions_already_there_are_registered(spark, table_run):
    domain = f"d{uuid4().hex}"
    ddl = DDL.replace("(id BIGINT)", "(id BIGINT, ymd STRING)").replace("LOCATION", "PARTITIONED BY (ymd) LOCATION")
    definition = TableDefinition("refined", domain, "orders", ddl)
    create_tables(spark, [definition], table_run)
    table = table_run.table_name(definition.dotted)
    assert spark.table(table).count() == 0
    spark.sql(f"INSERT INTO {table} VALUES (7, '2023-11-05')")
    drop_table(spark, table_run, "refined", domain, "orders")
    create_tables(spark, [definition], table_run)
    assert rows(spark.table(table)) == [(7, "2023-11-05")]


@pytest.mark.parametrize("name", [("", "sample", "orders"), ("refined", "", "orders"), ("refined", "sample", "")])
def test_dropping_needs_the_whole_name(spark, table_run, name):
    with pytest.raises(ValueError):
        drop_table(spark, table_run, *name)


# Tables that differ from their definitions


@pytest.fixture
def table(spark, table_run):
    """A table as first defined, with a row, and later definitions of it: ``now(columns, by, format)``."""
    domain = f"d{uuid4().hex}"

    def now(columns, by="ymd", made_of="${format}", name="parcels"):
        ddl = f"CREATE TABLE IF NOT EXISTS ${{name}} ({columns}) USING {made_of}"
        ddl += f" PARTITIONED BY ({by})" if by else ""
        return TableDefinition("refined", domain, name, ddl + " LOCATION '${warehouse}/${domain}/${table}'")

    (now.table,) = create_tables(spark, [now(BEFORE)], table_run)
    spark.sql(f"INSERT INTO {now.table} VALUES (7, 1.50, 'ab', '2023-11-05')")
    now.domain = domain
    return now


BEFORE = "id BIGINT, price DECIMAL(10,2), code VARCHAR(5), ymd STRING"


def test_an_added_column_arrives(spark, table_run, table):
    later = table("ymd STRING, id BIGINT NOT NULL, `no. of` INT COMMENT 'it''s new', price DECIMAL(10,2), code VARCHAR(5), tags ARRAY<STRING>")
    assert [one.name for one in table_drift(spark, later, table_run).added] == ["no. of", "tags"]
    assert align_tables(spark, [later], table_run) == {table.table: ["no. of", "tags"]}
    spark.sql(f"INSERT INTO {table.table} VALUES (8, 2.5, 'c', 3, array('x'), '2023-11-06')")
    found = spark.table(table.table).select("id", "`no. of`", "tags", "ymd")
    assert rows(found) == [(7, None, None, "2023-11-05"), (8, 3, ["x"], "2023-11-06")]
    described = spark.sql(f"DESCRIBE TABLE {table.table}").where("col_name = 'no. of'").first()
    assert described.comment == "it's new"
    assert align_tables(spark, [later], table_run) == {table.table: []}


@pytest.mark.parametrize(
    ("columns", "by", "made_of", "message"),
    [
        (BEFORE.replace("BIGINT", "STRING"), "ymd", "parquet", "column id is bigint, not string"),
        (BEFORE.replace("(10,2)", "(12,2)"), "ymd", "parquet", r"price is decimal\(10,2\), not decimal\(12,2\)"),
        (BEFORE.replace("VARCHAR(5)", "STRING"), "ymd", "parquet", r"code is varchar\(5\), not string"),
        (BEFORE.replace("price DECIMAL(10,2), ", ""), "ymd", "parquet", "column price is not in the definition"),
        (BEFORE + ", hms STRING", "ymd, hms", "parquet", "partition column hms is not there"),
        (BEFORE, "", "parquet", "partitioned by"),
        (BEFORE, "code", "parquet", "partitioned by"),
        (BEFORE, "ymd", "orc", "made of parquet, not orc"),
    ],
)
def test_any_other_change_is_refused_before_a_write(spark, table_run, table, columns, by, made_of, message):
    """Also what could be done to other tables of the same call is left undone."""
    another, absent = table(BEFORE, name="boxes"), table("id BIGINT", by="", name="crates")
    create_tables(spark, [another], table_run)
    changes = [table(columns, by, made_of), table(BEFORE + ", more INT", name="boxes"), absent]
    with pytest.raises(ValueError, match=message):
        align_tables(spark, changes, table_run)
    assert "more" not in spark.table(table_run.table_name(another.dotted)).columns
    assert not spark.catalog.tableExists(table_run.table_name(absent.dotted))
    assert rows(spark.table(table.table).select("id")) == [(7,)]


def test_absent_tables_are_created(spark, table_run, table):
    assert align_tables(spark, [table("id BIGINT", by="", name="crates")], table_run, "refined", table.domain, "crates")
    assert [row.tableName for row in list_tables(spark, table_run, "refined", table.domain).collect()] == ["crates", "parcels"]


def test_columns_are_not_added_where_old_files_cannot_lack_them(spark, table_run, table):
    create_tables(spark, [table("id BIGINT", by="", made_of="csv", name="lines")], table_run)
    with pytest.raises(ValueError, match="cannot be added to files of csv"):
        align_tables(spark, [table("id BIGINT, more INT", by="", made_of="csv", name="lines")], table_run)


def test_what_cannot_be_compared(spark, table_run, table):
    for ddl in ((DDL, "ALTER TABLE ${name} SET TBLPROPERTIES ('a' = 'b')"), "CREATE TABLE IF NOT EXISTS ${name} USING parquet AS SELECT 1 AS id"):
        with pytest.raises(ValueError, match="one CREATE TABLE"):
            align_tables(spark, [TableDefinition("refined", table.domain, "parcels", ddl)], table_run)
