"""

Each query sets up the datasets it needs from the given tables, does its step
with the library, and returns what a reader then finds. Queries whose step is a
write stage their data in a new folder (see ``staging_folder``).
"""

from __future__ import annotations

import re
import sys
import tempfile
import time
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import wraps
from importlib import import_module
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from layerline import RunContext, open_datasets  # noqa: E402
from layerline.functions import conform, day_of  # noqa: E402
from layerline.operators import (  # noqa: E402
    compact,
    compact_table,
    group_counts,
    group_totals,
    preview,
    remove_replaced,
    sort_rows,
)
from layerline.plans import catalog, events, orders  # noqa: E402
from layerline.sources import Dataset, read_dataset  # noqa: E402
from layerline.sources.catalog import quoted  # noqa: E402
from layerline.sources.folders import (  # noqa: E402
    STAGING_SETTING,
    data_files,
    folder_entries,
    remove_folder,
    staging_folder,
)
from layerline.sources.provision import LAYERS, TableDefinition, align_tables, create_tables, list_tables  # noqa: E402
from layerline.sources.run import SESSION_CATALOG  # noqa: E402

#: Where the given tables lie.
DATA = Path("/root/testdata")
YMD, HMS = "2024-01-02", "000101"
RAW_ORDER_SCHEMA = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


# Set-up shared by the queries

#: Seconds spent so far on putting the given tables where a query's step finds them, which bench.py takes off.
setup_seconds = 0.0


@contextmanager
def _setting_up() -> Iterator[None]:
    global setup_seconds
    start = time.perf_counter()
    yield
    setup_seconds += time.perf_counter() - start


def _with_shared_folder(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A local session that names no shared folder gets one of this machine; a cluster has to name its own."""

    @wraps(query)
    def run(spark, sf_dir):
        named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(STAGING_SETTING, None)
        if not named and spark.sparkContext.master.startswith("local"):
            application = spark.sparkContext.applicationId
            spark.conf.set(STAGING_SETTING, f"{tempfile.gettempdir()}/layerline-{application}")
        return query(spark, sf_dir)

    return run


def _run(warehouse: str, catalog_name: str | None = None, env: str = "local") -> RunContext:
    return RunContext(warehouse=warehouse, catalog=catalog_name, env=env, ymd=YMD, hms=HMS)


def _given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read as a path dataset whose warehouse is the data folder."""
    specs = {"input": {name: {"type": "path", "path": f"{name}.parquet"}}}
    return open_datasets(spark, specs, _run(sf_dir))[0].read(name)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.from_tpch_orders(_given(spark, sf_dir, "orders"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "events").withColumn("ymd", day_of("ts"))


def _finished() -> Column:
    """Null-safe, so that this and its negation cover every row."""
    return F.col("status").eqNullSafe("F")


def _new_place(spark: SparkSession, label: str, catalog_name: str | None = None) -> RunContext:
    return _run(staging_folder(spark, label), catalog_name)


def _stored(spark: SparkSession, run: RunContext, spec: dict):
    """Write and read functions of one dataset."""
    specs = {"input": {"it": spec}, "output": {"it": spec}}
    inputs, outputs = open_datasets(spark, specs, run)
    return (lambda df, **more: outputs.write("it", df, **more)), (lambda: inputs.read("it"))


def _order_files(mode: str = "overwrite", **spec) -> dict:
    return {"type": "path", "path": "refined/sample/orders", "mode": mode, **spec}


_landed: dict[tuple[str, str], RunContext] = {}


def _landed_events(spark: SparkSession, sf_dir: str) -> RunContext:
    """All events in one directory per day, as a day's run finds them; landed once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        with _setting_up():
            run = _new_place(spark, "events")
            by_day = {"type": "path", "path": "raw/events/impression", "partition_by": ["ymd"], "rebalance": 1000}
            write, _ = _stored(spark, run, by_day)
            write(_events(spark, sf_dir))
        _landed[key] = run
    return _landed[key]


def _own_domain(spark: SparkSession, run: RunContext, label: str) -> str:
    """A domain for one query, since the session's tables are shared by all. What its last run left is dropped."""
    domain = re.sub(r"\W", "_", f"{label}_{spark.sparkContext.applicationId}")
    for layer in LAYERS:
        namespace = run.table_name(f"{layer}.{domain}._").removesuffix("._")
        spark.sql(f"DROP NAMESPACE IF EXISTS {quoted(namespace)} CASCADE")
    return domain


def _own_table(spark: SparkSession, label: str, definition: TableDefinition) -> tuple[RunContext, str]:
    with _setting_up():
        run = _new_place(spark, label, SESSION_CATALOG)
        own = replace(definition, domain=_own_domain(spark, run, label))
        create_tables(spark, [own], run)
    return run, own.dotted


_ORDERS, _ORDERS_BY_DAY = catalog.TABLES
_ORDERS_BY_STATUS = replace(_ORDERS, ddl=_ORDERS.ddl.replace("LOCATION", "PARTITIONED BY (status) LOCATION"))


# Scans


def scan_path_parquet(spark, sf_dir):
    return _orders(spark, sf_dir)


def _scan_format(file_format: str, **options):
    def query(spark, sf_dir):
        spec = _order_files(format=file_format, options=options, schema=orders.ORDER_SCHEMA)
        with _setting_up():
            write, read = _stored(spark, _new_place(spark, f"scan-{file_format}"), spec)
            write(_orders(spark, sf_dir))
        return read()

    return query


def scan_run_partition(spark, sf_dir):
    inputs, _ = open_datasets(spark, events.DAILY_SPECS, _landed_events(spark, sf_dir))
    return inputs.read("impression")


def scan_run_time(spark, sf_dir):
    """A run's own directory down to the time of day, whose leading zeros have to survive."""
    leaf = "refined/sample/orders/ymd={ymd}/hms={hms}"
    with _setting_up():
        run = _new_place(spark, "scan-run-time")
        write, _ = _stored(spark, run, {"type": "path", "path": leaf})
        write(_orders(spark, sf_dir))
    read = {
        "type": "path",
        "path": leaf,
        "schema": f"{orders.ORDER_SCHEMA}, ymd STRING, hms STRING",
        "options": {"basePath": run.location("refined/sample/orders")},
    }
    return open_datasets(spark, {"input": {"orders": read}}, run)[0].read("orders")


def scan_options_basepath(spark, sf_dir):
    run = _landed_events(spark, sf_dir)
    day = {
        **events.DAILY_SPECS["input"]["impression"],
        "schema": events.EVENT_SCHEMA,
        "options": {"basePath": run.location("raw/events/impression")},
    }
    return open_datasets(spark, {"input": {"impression": day}}, run)[0].read("impression")


def scan_table(spark, sf_dir):
    ddl = f"CREATE TABLE ${{name}} ({RAW_ORDER_SCHEMA}) USING parquet LOCATION '{sf_dir.rstrip('/')}/orders.parquet'"
    run, name = _own_table(spark, "scan-table", replace(_ORDERS, layer="raw", ddl=ddl))
    inputs, _ = open_datasets(spark, {"input": {"orders": {"type": "table", "table": name}}}, run)
    return orders.from_tpch_orders(inputs.read("orders"))


def scan_table_by_path(spark, sf_dir):
    specs = {"input": {"orders": {"type": "table", "path": "orders.parquet", "format": "parquet"}}}
    return orders.from_tpch_orders(open_datasets(spark, specs, _run(sf_dir))[0].read("orders"))


def scan_cross_env(spark, sf_dir):
    """Finished orders are files here; the others are files of one other environment and a table of a third."""
    place = staging_folder(spark, "scan-cross-env")
    rows = _orders(spark, sf_dir)
    large = F.coalesce(F.col("amount") > 100000, F.lit(False))
    parts = {"local": _finished(), "annex": ~_finished() & large, "vault": ~_finished() & ~large}
    with _setting_up():
        for env in ("local", "annex"):
            write, _ = _stored(spark, _run(f"{place}/{env}", env=env), _order_files())
            write(rows.where(parts[env]))
        run, name = _own_table(spark, "scan-cross-env", _ORDERS)
        write, _ = _stored(spark, run, {"type": "table", "table": name, "mode": "append"})
        write(rows.where(parts["vault"]))
    environments = {
        "annex": {"warehouse": f"{place}/annex"},
        "vault": {"catalog": SESSION_CATALOG, "datasets": {"input": {"orders": {"type": "table", "table": name}}}},
    }
    inputs, _ = open_datasets(spark, {"input": {"orders": _order_files()}}, _run(f"{place}/local"), environments)
    local, annex, vault = (
        inputs(env).read("orders").withColumn("env", F.lit(env)) for env in ("local", "annex", "vault")
    )
    return local.unionByName(annex).unionByName(vault)


# Sinks on paths


def sink_path_overwrite(spark, sf_dir):
    write, read = _stored(spark, _new_place(spark, "overwrite"), _order_files())
    rows = _orders(spark, sf_dir)
    write(rows.where(_finished()))
    write(rows)
    return read()


def sink_path_append(spark, sf_dir):
    write, read = _stored(spark, _new_place(spark, "append"), _order_files("append"))
    rows = _orders(spark, sf_dir)
    write(rows.where(_finished()))
    write(rows.where(~_finished()))
    return read()


def sink_path_ignore(spark, sf_dir):
    write, read = _stored(spark, _new_place(spark, "ignore"), _order_files("ignore"))
    rows = _orders(spark, sf_dir)
    write(rows)
    write(rows.where(_finished()))
    return read()


def sink_path_partitioned(spark, sf_dir):
    # Few statuses: a task writes as few files, so gathering the rows first would only cost a shuffle.
    spec = _order_files(partition_by=["status"], rebalance=False, schema=orders.ORDER_SCHEMA)
    write, read = _stored(spark, _new_place(spark, "partitioned"), spec)
    write(_orders(spark, sf_dir))
    return read()


def sink_format_orc(spark, sf_dir):
    spec = _order_files(format="orc", options={"compression": "zlib"})
    write, read = _stored(spark, _new_place(spark, "orc"), spec)
    write(_orders(spark, sf_dir))
    return read()


def sink_run_partition(spark, sf_dir):
    """Events by day; then the run of one day is repeated and finds only clicks."""
    with _setting_up():
        run = _new_place(spark, "run-partition")
        by_day = {"type": "path", "path": "raw/events/impression", "partition_by": ["ymd"], "rebalance": 1000}
        write, _ = _stored(spark, run, by_day)
        write(_events(spark, sf_dir))
    # Compared as dates, Spark turns the day into a range of ts that reaches the scan.
    on_day = F.col("ts").cast("date") == F.lit(run.ymd).cast("date")
    clicks = _given(spark, sf_dir, "events").where(on_day & (F.col("event_type") == "click"))
    leaf = {"type": "path", "path": "raw/events/impression/ymd={ymd}", "mode": "overwrite"}
    write, _ = _stored(spark, run, leaf)
    write(clicks)
    return open_datasets(spark, events.BACKFILL_SPECS, run)[0].read("impression")


# Sinks on tables


def sink_table_append(spark, sf_dir):
    run, name = _own_table(spark, "table-append", _ORDERS)
    write, read = _stored(spark, run, {"type": "table", "table": name, "mode": "append"})
    rows = _orders(spark, sf_dir).select("customer_id", "order_date", "order_id", "amount", "status")
    write(rows.where(_finished()))
    write(rows.where(~_finished()))
    return read()


def sink_table_overwrite_partitions(spark, sf_dir):
    run, name = _own_table(spark, "table-overwrite", _ORDERS_BY_STATUS)
    spec = {"type": "table", "table": name, "mode": "overwrite_partitions", "rebalance": False}
    write, read = _stored(spark, run, spec)
    rows = _orders(spark, sf_dir)
    write(rows)
    write(rows.where(_finished() & (F.col("amount") > 100000)))
    return read()


def sink_table_by_path(spark, sf_dir):
    spec = {"type": "table", "path": "refined/sample/orders", "format": "parquet"}
    write, read = _stored(spark, _new_place(spark, "table-by-path"), spec)
    write(_orders(spark, sf_dir))
    return read()


# Operators


def agg_group_count(spark, sf_dir):
    return group_counts(_orders(spark, sf_dir), "status", count_as="order_count")


def agg_group_sum_rounded(spark, sf_dir):
    return group_totals(
        _orders(spark, sf_dir), "status", total_of="amount", count_as="order_count", total_as="total_amount"
    )


def sort_orders(spark, sf_dir):
    return sort_rows(_orders(spark, sf_dir), "order_id")


def topn_preview(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    return preview(rows, *rows.columns)  # All columns, so that equal ids are not left to chance.


def metric_row_count(spark, sf_dir):
    write, _ = _stored(spark, _new_place(spark, "row-count"), _order_files())
    rows = write(_orders(spark, sf_dir), count_rows=True)
    return spark.createDataFrame([(rows,)], "row_count BIGINT")


# Jobs


def job_orders_summary(spark, sf_dir):
    specs = {"input": {"orders": {"type": "path", "path": "orders.parquet"}}}
    run = _run(sf_dir)
    return orders.orders_summary(spark, *open_datasets(spark, specs, run), run, prepare=orders.from_tpch_orders)


def metric_summary(spark, sf_dir):
    """The summary's metrics are whole, whatever becomes of its rows."""
    inputs, _ = open_datasets(spark, {"input": {"orders": {"type": "path", "path": "orders.parquet"}}}, _run(sf_dir))
    run, metrics = _new_place(spark, "metric-summary"), Observation()
    _, outputs = open_datasets(spark, {"output": {"summary": {"type": "path", "path": "mart/orders/summary"}}}, run)
    summary = orders.orders_summary(spark, inputs, outputs, run, prepare=orders.from_tpch_orders, metrics=metrics)
    summary.take(1)
    found = metrics.get
    return spark.createDataFrame([(found["source_rows"], found["groups"])], "source_rows BIGINT, groups BIGINT")


def _orders_ingest(spark, sf_dir, label: str, specs: dict, definition: TableDefinition, runs: int) -> DataFrame:
    run, name = _own_table(spark, label, definition)
    seed = {"orders_seed": {"type": "path", "path": "orders.parquet"}}
    target = {"orders": {**specs["output"]["orders"], "table": name}}
    inputs, _ = open_datasets(spark, {"input": seed}, _run(sf_dir))
    _, outputs = open_datasets(spark, {"output": target}, run)
    for _ in range(runs):
        table = orders.orders_ingest(spark, inputs, outputs, run, prepare=orders.from_tpch_orders)
    return table


def job_orders_ingest(spark, sf_dir):
    return _orders_ingest(spark, sf_dir, "ingest", orders.INGEST_SPECS, _ORDERS, runs=1)


def job_orders_ingest_rerun(spark, sf_dir):
    """The form that may be repeated: two runs of a day leave its rows once."""
    return _orders_ingest(spark, sf_dir, "ingest-rerun", orders.RERUN_SPECS, _ORDERS_BY_DAY, runs=2)


def job_events_daily(spark, sf_dir):
    """Every day's summary by one backfill; then one day is run again on its own."""
    landed, run = _landed_events(spark, sf_dir), _new_place(spark, "events-daily")
    for job, specs in ((events.events_backfill, events.BACKFILL_SPECS), (events.events_daily, events.DAILY_SPECS)):
        inputs, _ = open_datasets(spark, {"input": specs["input"]}, landed)
        _, outputs = open_datasets(spark, {"output": specs["output"]}, run)
        job(spark, inputs, outputs, run)
    summary = {"type": "path", "path": "mart/events/summary", "schema": events.SUMMARY_SCHEMA}
    return open_datasets(spark, {"input": {"summary": summary}}, run)[0].read("summary")


def _provisioned(spark, sf_dir, label: str) -> tuple[RunContext, str]:
    """All tables of the catalog job, in a domain of their own, with the orders ingested."""
    run = _new_place(spark, label, SESSION_CATALOG)
    domain = _own_domain(spark, run, label)
    tables = [replace(one, domain=domain) for one in catalog.TABLES]
    create_tables(spark, tables, run, layer="refined", domain=domain)
    write, _ = _stored(spark, run, {"type": "table", "table": f"refined.{domain}.orders", "mode": "append"})
    write(_orders(spark, sf_dir))
    create_tables(spark, tables, run)  # Applying again leaves tables and rows alone.
    return run, domain


def _is_listed(spark, run: RunContext, domain: str) -> Column:
    return F.lit(not list_tables(spark, run, "refined", domain).where("tableName = 'orders'").isEmpty())


def ddl_apply(spark, sf_dir):
    """Provision the tables and read the ingested orders through the catalog."""
    run, domain = _provisioned(spark, sf_dir, "ddl-apply")
    table = {"type": "table", "table": f"refined.{domain}.orders"}
    rows = open_datasets(spark, {"input": {"orders": table}}, run)[0].read("orders")
    return rows.withColumn("table_exists", _is_listed(spark, run, domain))


def ddl_drop(spark, sf_dir):
    """Drop the table; its files stay where they are."""
    run, domain = _provisioned(spark, sf_dir, "ddl-drop")
    catalog.drop_from_catalog(spark, run, "refined", domain, "orders")
    files = {"type": "table", "path": f"refined/{domain}/orders", "format": "parquet"}
    rows = open_datasets(spark, {"input": {"orders": files}}, run)[0].read("orders")
    return rows.withColumn("table_exists", _is_listed(spark, run, domain))


def stream_ingest_available_now(spark, sf_dir):
    """Two runs over the same files; the second finds nothing new."""
    # A stream takes its path for a directory; the pattern also fits a table that is one file.
    arriving = {"type": "stream", "path": "orders.parquet*", "schema": RAW_ORDER_SCHEMA}
    taken = {**_order_files("append"), "type": "stream", "checkpoint": "checkpoints/orders"}
    inputs, _ = open_datasets(spark, {"input": {"orders": arriving}}, _run(sf_dir))
    run = _new_place(spark, "stream")
    _, outputs = open_datasets(spark, {"output": {"orders": taken}}, run)
    for _ in range(2):
        outputs.write("orders", orders.from_tpch_orders(inputs.read("orders")))
    return open_datasets(spark, {"input": {"orders": _order_files()}}, run)[0].read("orders")


def stream_ingest_partitioned(spark, sf_dir):
    """The stream's target in a directory per status, each written by a few tasks."""
    arriving = {"type": "stream", "path": "orders.parquet*", "schema": RAW_ORDER_SCHEMA}
    by_status = {"partition_by": ["status"], "rebalance": 2, "checkpoint": "checkpoints/orders"}
    inputs, _ = open_datasets(spark, {"input": {"orders": arriving}}, _run(sf_dir))
    run = _new_place(spark, "stream-partitioned")
    taken = {**_order_files("append"), "type": "stream", **by_status}
    _, outputs = open_datasets(spark, {"output": {"orders": taken}}, run)
    outputs.write("orders", orders.from_tpch_orders(inputs.read("orders")))
    written = _order_files(schema=orders.ORDER_SCHEMA)
    return open_datasets(spark, {"input": {"orders": written}}, run)[0].read("orders")


def compact_partition(spark, sf_dir):
    """All events landed as one partition, in directories by hour with leading zeros, and rewritten as fewer files."""
    landed = {
        "type": "path",
        "path": "raw/events/impression/ymd={ymd}",
        "partition_by": ["hour"],
        "schema": f"{events.EVENT_SCHEMA.removesuffix(', ymd STRING')}, hour STRING",
    }
    with _setting_up():
        run = _new_place(spark, "compact")
        write, _ = _stored(spark, run, landed)
        write(_given(spark, sf_dir, "events").withColumn("hour", F.date_format("ts", "HH")))
    specs = {
        "input": {"events": landed},
        "output": {"events": {"type": "path", "path": "compacted/events/impression/ymd={ymd}"}},
    }
    inputs, outputs = open_datasets(spark, specs, run)
    return compact(spark, inputs["events"], outputs["events"])


# Streams, compaction, appends and definitions that are repeated or cut short. Over
# conversations, whose number grows with the data.

CONVERSATION_SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
_CONVERSATIONS = TableDefinition(
    "refined",
    "sample",
    "conversations",
    f"CREATE TABLE IF NOT EXISTS ${{name}} ({CONVERSATION_SCHEMA}) USING ${{format}} PARTITIONED BY (role) "
    "LOCATION '${warehouse}/${layer}/${domain}/${table}'",
)


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(
        _given(spark, sf_dir, "conversations"),
        {
            "conv_id": F.col("conv_id").cast("bigint"),
            "turn": F.col("turn").cast("bigint"),
            "role": F.col("role"),
            "text": F.col("text"),
        },
    )


def _share(number: int, of: int) -> Column:
    return F.pmod(F.xxhash64("conv_id", "turn"), F.lit(of)) == number


def _landing(spark: SparkSession, run: RunContext):
    """A folder in which files arrive, as a function that lets rows arrive, and a spec to read it as a stream."""
    files = {"type": "path", "path": "landing/conversations", "mode": "append"}
    write, _ = _stored(spark, run, files)

    def arrive(rows: DataFrame) -> None:
        with _setting_up():
            write(rows)

    return arrive, {"type": "stream", "path": "landing/conversations", "schema": CONVERSATION_SCHEMA}


def stream_archived(spark, sf_dir):
    """Three runs, each of what arrived since the last; files taken leave, and each run begins a new log of them."""
    run, name = _own_table(spark, "stream-archived", _CONVERSATIONS)
    arrive, arriving = _landing(spark, run)
    taken = {"type": "stream", "table": name, "checkpoint": "checkpoints/c", "archive": "archive/c", "log_files": 1}
    inputs, outputs = open_datasets(spark, {"input": {"c": arriving}, "output": {"c": taken}}, run)
    rows, counted = _conversations(spark, sf_dir), 0
    for i in range(3):
        arrive(rows.where(_share(i, 3)))
        counted += outputs.write("c", inputs.read("c"), count_rows=True)
    left = len(data_files(spark, run.location("landing/conversations")))
    logs = len(folder_entries(spark, run.location("checkpoints/c")))
    marks = {"files_left": F.lit(left), "logs": F.lit(logs), "counted": F.lit(counted)}
    return read_dataset(spark, _table_dataset(run, name)).withColumns(marks)


def _table_dataset(run: RunContext, name: str) -> Dataset:
    return Dataset("it", "table", run.table_name(name), by_path=False)


def stream_into_table(spark, sf_dir):
    """A run that ends between its last write and the commit of it: the batch comes again and changes nothing."""
    run, name = _own_table(spark, "stream-table", _CONVERSATIONS)
    arrive, arriving = _landing(spark, run)
    taken = {"type": "stream", "table": name, "checkpoint": "checkpoints/c"}
    inputs, outputs = open_datasets(spark, {"input": {"c": arriving}, "output": {"c": taken}}, run)
    rows = _conversations(spark, sf_dir)
    for i in range(2):
        arrive(rows.where(_share(i, 2)))
        outputs.write("c", inputs.read("c"))
        if i == 0:
            remove_folder(spark, run.location("checkpoints/c/commits"))
    return read_dataset(spark, _table_dataset(run, name))


def stream_row_count(spark, sf_dir):
    """Rows of all micro-batches: of Spark's own sink, by steps, and of a path with a record of each."""
    run = _new_place(spark, "stream-count")
    arrive, arriving = _landing(spark, run)
    arrive(_conversations(spark, sf_dir).repartition(4))
    steps = {**arriving, "batch_bytes": 1}
    to = {"type": "stream", "partition_by": ["role"]}
    specs = {
        "input": {"whole": arriving, "steps": steps},
        "output": {
            "whole": {**to, "path": "refined/whole", "checkpoint": "checkpoints/whole", "once": True},
            "steps": {**to, "path": "refined/steps", "checkpoint": "checkpoints/steps"},
        },
    }
    inputs, outputs = open_datasets(spark, specs, run)
    counts = [(name, outputs.write(name, inputs.read(name), count_rows=True)) for name in specs["input"]]
    return spark.createDataFrame(counts, "stream STRING, row_count BIGINT")


def compact_switch_readers(spark, sf_dir):
    """A table of many small files: its partitions are rewritten in one job, and readers by name find the new files."""
    run, name = _own_table(spark, "compact-table", _CONVERSATIONS)
    with _setting_up():
        write, _ = _stored(spark, run, {"type": "table", "table": name, "mode": "append", "rebalance": False})
        rows = _conversations(spark, sf_dir)
        for i in range(3):
            write(rows.where(_share(i, 3)).repartition(4))
    table = _table_dataset(run, name)
    remove_replaced(spark, compact_table(spark, table))
    read = read_dataset(spark, table)
    return read.withColumn("files", F.lit(read.select("_metadata.file_path").distinct().count()))


def sink_path_swap(spark, sf_dir):
    """An overwrite that fails half way leaves the old rows, and one that ends well replaces them."""
    spec = {"type": "path", "path": "refined/conversations", "swap": True}
    write, read = _stored(spark, _new_place(spark, "swap"), spec)
    rows = _conversations(spark, sf_dir)
    write(rows.where(_share(0, 2)))
    try:
        write(rows.withColumn("text", F.raise_error(F.lit("half way")).cast("string")))
    except Exception as failure:
        if "half way" not in str(failure):
            raise
    kept = read().count()
    write(rows)
    return read().withColumn("kept", F.lit(kept) > 0)


def job_orders_ingest_once(spark, sf_dir):
    """The append that may be repeated: two runs under one day and time leave its rows once."""
    return _orders_ingest(spark, sf_dir, "ingest-once", orders.ONCE_SPECS, _ORDERS, runs=2)


def ddl_align(spark, sf_dir):
    """A table from before a column was added to its definition, with rows, and rows after; a changed type is refused."""
    earlier = replace(_CONVERSATIONS, ddl=_CONVERSATIONS.ddl.replace(", text STRING", ""))
    run, name = _own_table(spark, "ddl-align", earlier)
    now = replace(_CONVERSATIONS, domain=name.split(".")[1])
    rows = _conversations(spark, sf_dir)
    write, _ = _stored(spark, run, {"type": "table", "table": name, "mode": "append"})
    write(rows.where("turn = 0").drop("text"))
    align_tables(spark, [now], run)
    write(rows.where("turn IS DISTINCT FROM 0"))
    try:
        align_tables(spark, [replace(now, ddl=now.ddl.replace("turn BIGINT", "turn STRING"))], run)
        refused = False
    except ValueError:
        refused = True
    return read_dataset(spark, _table_dataset(run, name)).withColumn("refused", F.lit(refused))


# The same results in SQL

_ORDERS_SQL = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
           o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d') AS order_date
    FROM orders"""
_COUNT_SQL = "SELECT o_orderstatus AS status, count(*) AS order_count FROM orders GROUP BY 1"
# Summed as decimals: a sum of doubles depends on the order of the rows.
_SUMMARY_SQL = """
    SELECT o_orderstatus AS status, count(*) AS order_count,
           CAST(round(sum(CAST(o_totalprice AS DECIMAL(38, 15))), 2) AS DOUBLE) AS total_amount
    FROM orders GROUP BY 1 ORDER BY 1 NULLS FIRST"""
_DAY_SQL = "strftime(ts, '%Y-%m-%d')"

_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "scan_path_parquet": (scan_path_parquet, _ORDERS_SQL),
    "scan_format_orc": (_scan_format("orc"), _ORDERS_SQL),
    "scan_format_json": (_scan_format("json"), _ORDERS_SQL),
    "scan_format_csv": (_scan_format("csv", header=True), _ORDERS_SQL),
    "scan_run_partition": (scan_run_partition, f"SELECT * FROM events WHERE {_DAY_SQL} = '{YMD}'"),
    "scan_run_time": (scan_run_time, f"SELECT *, '{YMD}' AS ymd, '{HMS}' AS hms FROM ({_ORDERS_SQL})"),
    "scan_options_basepath": (
        scan_options_basepath,
        f"SELECT *, {_DAY_SQL} AS ymd FROM events WHERE {_DAY_SQL} = '{YMD}'",
    ),
    "scan_table": (scan_table, _ORDERS_SQL),
    "scan_table_by_path": (scan_table_by_path, _ORDERS_SQL),
    "scan_cross_env": (
        scan_cross_env,
        f"""SELECT *, CASE WHEN status = 'F' THEN 'local' WHEN amount > 100000 THEN 'annex' ELSE 'vault' END AS env
            FROM ({_ORDERS_SQL})""",
    ),
    "sink_path_overwrite": (sink_path_overwrite, _ORDERS_SQL),
    "sink_path_append": (sink_path_append, _ORDERS_SQL),
    "sink_path_ignore": (sink_path_ignore, _ORDERS_SQL),
    "sink_path_partitioned": (sink_path_partitioned, _ORDERS_SQL),
    "sink_format_orc": (sink_format_orc, _ORDERS_SQL),
    "sink_run_partition": (
        sink_run_partition,
        f"SELECT *, {_DAY_SQL} AS ymd FROM events WHERE NOT ({_DAY_SQL} = '{YMD}' AND event_type <> 'click')",
    ),
    "sink_table_append": (sink_table_append, _ORDERS_SQL),
    "sink_table_overwrite_partitions": (
        sink_table_overwrite_partitions,
        _ORDERS_SQL + " WHERE o_orderstatus IS DISTINCT FROM 'F' OR o_totalprice > 100000",
    ),
    "sink_table_by_path": (sink_table_by_path, _ORDERS_SQL),
    "agg_group_count": (agg_group_count, _COUNT_SQL),
    "agg_group_sum_rounded": (agg_group_sum_rounded, _SUMMARY_SQL),
    "sort_orders": (sort_orders, _ORDERS_SQL + " ORDER BY order_id NULLS FIRST"),
    "topn_preview": (
        topn_preview,
        _ORDERS_SQL
        + """ ORDER BY order_id NULLS FIRST, customer_id NULLS FIRST, status NULLS FIRST,
                       amount NULLS FIRST, order_date NULLS FIRST LIMIT 20""",
    ),
    "metric_row_count": (metric_row_count, "SELECT count(*) AS row_count FROM orders"),
    "metric_summary": (
        metric_summary,
        f"SELECT CAST(sum(order_count) AS BIGINT) AS source_rows, count(*) AS groups FROM ({_COUNT_SQL})",
    ),
    "job_orders_summary": (job_orders_summary, _SUMMARY_SQL),
    "job_orders_ingest": (job_orders_ingest, _ORDERS_SQL),
    "job_orders_ingest_rerun": (job_orders_ingest_rerun, f"SELECT *, '{YMD}' AS ymd FROM ({_ORDERS_SQL})"),
    "job_events_daily": (
        job_events_daily,
        f"""SELECT event_type, count(*) AS event_count,
                   CAST(round(sum(CAST(value AS DECIMAL(38, 15))), 2) AS DOUBLE) AS total_value, {_DAY_SQL} AS ymd
            FROM events GROUP BY event_type, ymd""",
    ),
    "ddl_apply": (ddl_apply, f"SELECT *, true AS table_exists FROM ({_ORDERS_SQL})"),
    "ddl_drop": (ddl_drop, f"SELECT *, false AS table_exists FROM ({_ORDERS_SQL})"),
    "stream_ingest_available_now": (stream_ingest_available_now, _ORDERS_SQL),
    "stream_ingest_partitioned": (stream_ingest_partitioned, _ORDERS_SQL),
    "compact_partition": (compact_partition, "SELECT *, strftime(ts, '%H') AS hour FROM events"),
    "stream_archived": (
        stream_archived,
        "SELECT *, 0 AS files_left, 1 AS logs, (SELECT CAST(count(*) AS INTEGER) FROM conversations) AS counted FROM conversations",
    ),
    "stream_into_table": (stream_into_table, "SELECT * FROM conversations"),
    "stream_row_count": (
        stream_row_count,
        "SELECT unnest(['whole', 'steps']) AS stream, count(*) AS row_count FROM conversations",
    ),
    "compact_switch_readers": (compact_switch_readers, 
        "SELECT *, (SELECT CAST(count(*) AS INTEGER) FROM (SELECT DISTINCT role FROM conversations)) AS files FROM conversations",
    ),
    "sink_path_swap": (sink_path_swap, "SELECT *, true AS kept FROM conversations"),
    "job_orders_ingest_once": (job_orders_ingest_once, _ORDERS_SQL),
    "ddl_align": (
        ddl_align,
        "SELECT * REPLACE (CASE WHEN turn = 0 THEN NULL ELSE text END AS text), true AS refused FROM conversations",
    ),
}


def entry(spark: SparkSession) -> DataFrame:
    """The order summary over the smallest tables."""
    return job_orders_summary(spark, str(DATA / "sf0.001"))


def _optional(name: str):
    """The module, or None where it, the package of training-data operators, or a package that these need is not there."""
    try:
        return import_module(name)
    except ImportError as missing:
        # The package may be left out on purpose; what else is missing should be known.
        if not (missing.name or "").startswith(("layerline.llm", "corpus_pipeline")):
            warnings.warn(f"the queries of {name} are left out: {missing}", stacklevel=2)
        return None


def _training_data() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    """The queries of the training-data operators and of the pipeline made of them."""
    found = {}
    if operators := _optional("layerline.llm.queries"):
        found |= {name: (query, operators.ORACLE_SQL.get(name)) for name, query in operators.QUERIES.items()}
    if pipeline := _optional("corpus_pipeline"):
        found["pipeline"] = (pipeline.run, pipeline.ORACLE_SQL)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _with_shared_folder(query) for name, (query, _) in (_QUERIES | _training_data()).items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in (_QUERIES | _training_data()).items() if sql}
