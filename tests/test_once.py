"""Appends that may be repeated."""

from __future__ import annotations

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from layerline import RunContext, open_datasets
from layerline.plans import orders
from layerline.sources import once
from layerline.sources.once import partition_clause, partition_values
from layerline.sources.provision import TableDefinition, create_tables
from tests.conftest import rows

SCHEMA = "id BIGINT, amount DECIMAL(10,2), kind STRING"
KEY = "seed-{ymd}-{hms}"
RAW = {"type": "path", "path": "t", "mode": "append", "once": KEY, "schema": SCHEMA}


@pytest.fixture
def given(spark):
    kinds = F.element_at(F.array(F.lit("a"), F.lit("b/c: %41"), F.lit(None)), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(0, 60, 1, 4).select("id", F.col("id").cast("decimal(10,2)").alias("amount"), kinds.alias("kind"))


@pytest.fixture
def table(spark, table_run):
    domain = f"o{uuid4().hex}"
    ddl = f"CREATE TABLE ${{name}} ({SCHEMA}) USING ${{format}} PARTITIONED BY (kind) LOCATION '${{warehouse}}/{domain}'"
    create_tables(spark, [TableDefinition("refined", domain, "orders", ddl)], table_run)
    return {"type": "table", "table": f"refined.{domain}.orders", "mode": "append", "once": KEY}


@pytest.fixture
def target(request, spark, run, table_run, store):
    spec = request.param
    if spec == "table":
        spec, run = request.getfixturevalue("table"), table_run

    def at(hms):
        return store(spec, at=RunContext(run.warehouse, run.catalog, run.env, run.ymd, hms))

    return at


TARGETS = [RAW, {**RAW, "partition_by": ["kind"]}, {**RAW, "format": "json"}, "table"]
each = pytest.mark.parametrize("target", TARGETS, indirect=True, ids=["files", "directories", "json", "table"])


@each
def test_a_run_adds_its_rows_once(target, given):
    write, read = target("010203")
    assert write(given, count_rows=True) == 60
    assert write(given, count_rows=True) == 60
    assert write(given.limit(3)) is None
    assert rows(read()) == rows(given)
    write, read = target("040506")
    assert write(given.where("id < 10"), count_rows=True) == 10
    assert read().count() == 70


@each
@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_run_that_ended_while_files_were_moved(monkeypatch, target, given, moved):
    before, calls = once.move, []

    def move(session, source, to):
        if "/part-" in source:
            calls.append(source)
            if len(calls) > moved:
                raise OSError("gone")
        before(session, source, to)

    write, read = target("010203")
    monkeypatch.setattr(once, "move", move)
    with pytest.raises(OSError, match="gone"):
        write(given.repartition(4))
    monkeypatch.setattr(once, "move", before)
    # What was written is moved on; the rows are not asked for again.
    assert write(given.limit(1), count_rows=True) == 60
    assert rows(read()) == rows(given)


@each
def test_a_run_that_ended_while_it_wrote(target, given):
    write, read = target("010203")
    with pytest.raises(Exception, match="broken"):
        write(given.withColumn("amount", F.when(F.col("id") == 59, F.raise_error(F.lit("broken"))).otherwise(F.col("amount"))))
    assert write(given, count_rows=True) == 60
    assert rows(read()) == rows(given)


@each
def test_no_rows(target, given):
    write, read = target("010203")
    assert write(given.where("false"), count_rows=True) == 0
    assert write(given, count_rows=True) == 0


def test_rows_go_where_the_partition_lies_now(spark, table_run, table, given, store, tmp_path):
    """As after a compaction."""
    write, read = store(table, at=table_run)
    write(given.where("kind = 'a'"))
    name = table_run.table_name(table["table"])
    spark.sql(f"ALTER TABLE {name} PARTITION (kind = 'a') SET LOCATION 'file://{tmp_path}/elsewhere'")
    later = RunContext(table_run.warehouse, table_run.catalog, "local", table_run.ymd, "235959")
    write, read = store(table, at=later)
    write(given)
    assert rows(read()) == rows(given)
    assert list((tmp_path / "elsewhere").glob("part-*"))


def test_types_are_those_of_the_table(table_run, table, given, store):
    write, read = store(table, at=table_run)
    write(given.withColumn("id", F.col("id").cast("int")).select("kind", "amount", "id"))
    assert rows(read()) == rows(given)


def test_the_ingest_job_twice_under_one_run(spark, table_run):
    domain = f"j{uuid4().hex}"
    ddl = f"CREATE TABLE ${{name}} ({orders.ORDER_SCHEMA}) USING ${{format}} LOCATION '${{warehouse}}/{domain}'"
    create_tables(spark, [TableDefinition("refined", domain, "orders", ddl)], table_run)
    seed = spark.createDataFrame([(1, 2, "F", 1.5, "2024-01-01"), (2, 2, "O", 2.5, "2024-01-02")], orders.ORDER_SCHEMA)
    seed.write.parquet(table_run.location("raw/sample/orders/orders.parquet"))
    specs = {**orders.ONCE_SPECS, "output": {"orders": {**orders.ONCE_SPECS["output"]["orders"], "table": f"refined.{domain}.orders"}}}
    for _ in range(2):
        found = orders.orders_ingest(spark, *open_datasets(spark, specs, table_run), table_run)
    assert found.count() == 2


def test_other_tables_are_refused(spark, monkeypatch, table_run, table, given, store):
    monkeypatch.setattr(once, "is_file_table", lambda *more: False)
    with pytest.raises(ValueError, match="overwrite_partitions"):
        store(table, at=table_run)[0](given)


@pytest.mark.parametrize(
    ("change", "message"),
    [({"mode": "overwrite"}, "does not go with overwrite"), ({"once": True}, "names the run"), ({"once": "{day}"}, "no value")],
)
def test_bad_specs(spark, run, change, message):
    with pytest.raises(ValueError, match=message):
        open_datasets(spark, {"output": {"t": {**RAW, **change}}}, run)


def test_partition_names():
    assert partition_values("day=2024-01-02/kind=a%2Fb%25") == {"day": "2024-01-02", "kind": "a/b%"}
    assert partition_clause(partition_values("a.b=x'y/k=__HIVE_DEFAULT_PARTITION__")) == r"PARTITION (`a.b` = 'x\'y', `k` = NULL)"
