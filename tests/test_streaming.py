from __future__ import annotations

import os
import time
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from layerline import open_datasets
from layerline.sources import once
from layerline.sources.provision import TableDefinition, create_tables
from layerline.streaming import ingest as ingest_module
from tests.conftest import rows

FILES = {"type": "stream", "path": "raw/n", "schema": "id BIGINT"}
TARGET = {"type": "stream", "path": "refined/n", "checkpoint": "checkpoints/n"}


@pytest.fixture
def ingest(spark, run):
    spark.range(3).write.parquet(run.location("raw/n"))

    def _ingest(options=None, **target):
        specs = {"input": {"n": {**FILES, "options": options or {}}}, "output": {"n": {**TARGET, **target}}}
        inputs, outputs = open_datasets(spark, specs, run)
        outputs.write("n", inputs.read("n").withColumn("odd", (F.col("id") % 2).cast("string")))
        return spark.read.schema("id BIGINT, odd STRING").parquet(outputs["n"].location)

    return _ingest


def test_a_second_run_adds_only_what_is_new(spark, run, ingest):
    assert rows(ingest()) == [(0, "0"), (1, "1"), (2, "0")]
    assert ingest().count() == 3
    spark.range(3, 5).write.mode("append").parquet(run.location("raw/n"))
    assert rows(ingest()) == [(0, "0"), (1, "1"), (2, "0"), (3, "1"), (4, "0")]


def test_a_backlog_is_taken_in_steps(spark, run, ingest):
    spark.range(3, 30, 1, 9).write.mode("append").parquet(run.location("raw/n"))
    assert ingest({"maxFilesPerTrigger": 2}).count() == 30


def test_partitioned_target(ingest):
    assert rows(ingest(partition_by=["odd"])) == [(0, "0"), (1, "1"), (2, "0")]


@pytest.mark.parametrize(("rebalance", "most"), [(3, 3), (True, 8)])
def test_a_partitioned_target_gets_few_files_per_value(spark, run, ingest, tmp_path, set_conf, rebalance, most):
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.range(3, 4000, 1, 16).write.mode("append").parquet(run.location("raw/n"))
    assert ingest(partition_by=["odd"], rebalance=rebalance).count() == 4000
    for odd in (0, 1):
        assert 1 < len(list((tmp_path / f"refined/n/odd={odd}").glob("*.parquet"))) <= most


def test_files_with_an_old_date_are_taken(spark, run, ingest, tmp_path):
    ingest()
    spark.range(3, 13).coalesce(1).write.mode("append").parquet(run.location("raw/n"))
    known = time.time() - 400 * 86400
    for file in sorted((tmp_path / "raw/n").glob("part-*"), key=os.path.getmtime)[-1:]:
        os.utime(file, (known, known))
    assert ingest().count() == 13


def test_a_batch_does_not_append_to_a_streams_folder(spark, run, ingest):
    ingest()
    batch = {"output": {"n": {"type": "path", "path": "refined/n", "mode": "append"}}}
    with pytest.raises(ValueError, match="belongs to a stream"):
        open_datasets(spark, batch, run)[1].write("n", spark.range(7).withColumn("odd", F.lit("0")), count_rows=True)


def test_batch_bytes(spark, run, ingest):
    spark.range(3, 30, 1, 9).write.mode("append").parquet(run.location("raw/n"))
    inputs, outputs = open_datasets(spark, {"input": {"n": {**FILES, "batch_bytes": 1}}, "output": {"n": TARGET}}, run)
    outputs.write("n", inputs.read("n").withColumn("odd", F.lit("0")))
    taken = spark.read.parquet(outputs["n"].location)
    assert taken.count() == 30
    # A file at a time, and so a file or more out of each batch.
    assert len(taken.inputFiles()) >= 9


def test_a_failed_run_is_taken_up_again(spark, run, ingest):
    inputs, outputs = open_datasets(spark, {"input": {"n": FILES}, "output": {"n": TARGET}}, run)
    broken = inputs.read("n").withColumn("odd", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        outputs.write("n", broken)
    assert rows(ingest()) == [(0, "0"), (1, "1"), (2, "0")]


def test_sources_without_a_path(spark, run):
    rate = {"type": "stream", "format": "rate", "options": {"rowsPerSecond": 1}}
    inputs, _ = open_datasets(spark, {"input": {"ticks": rate}}, run)
    assert inputs["ticks"].location == ""
    assert inputs.read("ticks").isStreaming


@pytest.mark.parametrize(
    ("group", "spec", "message"),
    [
        ("input", {"type": "stream", "path": "raw/n"}, "'path' and a 'schema'"),
        ("input", {**FILES, "batch_bytes": "1g"}, "batch_bytes is a number"),
        ("output", {"type": "stream", "path": "refined/n"}, "needs a 'checkpoint'"),
        ("output", {"type": "stream", "checkpoint": "c"}, "needs a 'checkpoint'"),
        ("output", {**TARGET, "mode": "overwrite"}, "cannot overwrite"),
    ],
)
def test_bad_specs(spark, run, group, spec, message):
    with pytest.raises(ValueError, match=message):
        open_datasets(spark, {group: {"n": spec}}, run)


def test_rows_of_all_batches_are_counted(spark, run, ingest):
    spark.range(3, 30, 1, 9).write.mode("append").parquet(run.location("raw/n"))
    for batch_bytes, partitioned in ((None, []), (1, []), (1, ["odd"])):
        name = f"{batch_bytes}{len(partitioned)}"
        source = {**FILES, "batch_bytes": batch_bytes} if batch_bytes else FILES
        target = {**TARGET, "path": f"refined/{name}", "checkpoint": f"checkpoints/{name}", "partition_by": partitioned}
        inputs, outputs = open_datasets(spark, {"input": {"n": source}, "output": {"n": target}}, run)
        odd = inputs.read("n").withColumn("odd", (F.col("id") % 2).cast("string"))
        assert outputs.write("n", odd, count_rows=True) == 30
        assert outputs.write("n", odd, count_rows=True) == 0


def test_more_batches_than_a_query_remembers(spark, run, set_conf):
    set_conf("spark.sql.streaming.numRecentProgressUpdates", "2")
    spark.range(0, 60, 1, 12).write.parquet(run.location("raw/n"))
    specs = {"input": {"n": {**FILES, "batch_bytes": 1}}, "output": {"n": TARGET}}
    inputs, outputs = open_datasets(spark, specs, run)
    assert outputs.write("n", inputs.read("n"), count_rows=True) == 60


# Streams into tables, and what they remember


@pytest.fixture
def into(spark, table_run):
    """A run of a stream into a table or a path with records: ``go()`` returns the rows counted."""
    domain = f"s{uuid4().hex}"
    ddl = "CREATE TABLE ${name} (id BIGINT, odd STRING) USING ${format} PARTITIONED BY (odd) LOCATION '${warehouse}/t'"
    create_tables(spark, [TableDefinition("refined", domain, "n", ddl)], table_run)
    target = {"type": "stream", "table": f"refined.{domain}.n", "checkpoint": "checkpoints/t"}

    def go(change=lambda df: df, source=FILES, **more):
        wanted = {**target, **more}
        if "path" in wanted:
            del wanted["table"]
        inputs, outputs = open_datasets(spark, {"input": {"n": source}, "output": {"n": wanted}}, table_run)
        rows = inputs.read("n").withColumn("odd", (F.col("id") % 2).cast("string"))
        return outputs.write("n", change(rows), count_rows=True)

    go.read = lambda: sorted(row.id for row in spark.table(table_run.table_name(target["table"])).collect())
    return go


def arrive(spark, run, *ids, files=1):
    spark.createDataFrame([(i,) for i in ids], "id BIGINT").repartition(files).write.mode("append").parquet(
        run.location("raw/n")
    )


def test_a_stream_into_a_table(spark, table_run, into):
    arrive(spark, table_run, 1, 2, 3)
    assert into() == 3 and into.read() == [1, 2, 3]
    assert into() == 0
    arrive(spark, table_run, 4, 5, files=2)
    assert into(source={**FILES, "batch_bytes": 1}) == 2 and into.read() == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("more", [{}, {"path": "refined/p", "once": True}])
def test_a_run_that_ends_between_write_and_commit(spark, table_run, into, tmp_path, more):
    """The batch is written, and its commit in the checkpoint is not: the next run is given it again."""
    arrive(spark, table_run, 1, 2, 3)
    into(**more)
    arrive(spark, table_run, 4, 5)
    into(**more)
    commits = sorted((tmp_path / "checkpoints/t/commits").glob("[0-9]*"), key=lambda file: int(file.name))
    commits[-1].unlink()
    for crc in (tmp_path / "checkpoints/t/commits").glob(".*.crc"):
        crc.unlink()
    arrive(spark, table_run, 6)
    # The rows of the batch that is repeated count for the run that commits it.
    assert into(**more) == 3
    found = into.read() if not more else sorted(r.id for r in spark.read.parquet(f"{tmp_path}/refined/p").collect())
    assert found == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("moved", [0, 1])
def test_a_run_that_ends_while_files_are_moved(spark, table_run, into, monkeypatch, moved):
    arrive(spark, table_run, *range(8), files=4)
    calls, before = [], once.move

    def move(session, source, target):
        if "/part-" in source:
            calls.append(source)
            if len(calls) > moved:
                raise OSError("the driver is gone")
        before(session, source, target)

    monkeypatch.setattr(once, "move", move)
    with pytest.raises(Exception, match="the driver is gone"):
        into()
    monkeypatch.setattr(once, "move", before)
    assert into() == 8 and into.read() == [*range(8)]


def test_only_the_last_record_of_a_stream_is_kept(spark, table_run, into, tmp_path):
    for i in range(4):
        arrive(spark, table_run, i)
        into()
    assert len(list((tmp_path / "t/.layerline").iterdir())) == 1


ARCHIVE = {"archive": "taken/n", "log_files": 3}


def test_what_a_stream_remembers_stays_bounded(spark, table_run, into, tmp_path):
    landing, names = tmp_path / "raw/n", 0
    for i in range(8):
        arrive(spark, table_run, 2 * i, 2 * i + 1, files=2)
        assert into(**ARCHIVE) == 2
        assert not list(landing.glob("part-*"))
        logs = [tmp_path / "checkpoints/t" / name for name in os.listdir(tmp_path / "checkpoints/t")]
        assert len(logs) == 1
        names = max(names, sum(len(file.read_text().split("\n")) - 1 for file in logs[0].glob("sources/0/[0-9]*")))
    assert names <= 3 + 2 and into.read() == [*range(16)]
    assert len([file for file in (tmp_path / "taken").rglob("part-*")]) == 16


def test_old_dates_and_names_used_before(spark, table_run, into, tmp_path):
    """After a new generation has begun, neither is a reason to pass a file over."""
    landing = tmp_path / "raw/n"
    spark.range(2).coalesce(1).write.parquet(f"file://{tmp_path}/made")
    (file,) = (tmp_path / "made").glob("part-*")
    landing.mkdir(parents=True)
    for i in range(3):
        arriving = landing / "same name ü+%41.parquet"
        arriving.write_bytes(file.read_bytes())
        os.utime(arriving, (time.time() - (400 + i) * 86400,) * 2)
        assert into(**{**ARCHIVE, "log_files": 1}) == 2
        assert not arriving.exists()
    assert into.read() == [0, 0, 0, 1, 1, 1]
    assert len(list((tmp_path / "taken").rglob("same name ü+%41.parquet"))) == 3


def test_a_failed_run_stays_in_its_generation(spark, table_run, into, tmp_path):
    arrive(spark, table_run, 1, 2)
    broken = lambda df: df.withColumn("odd", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        into(broken, **ARCHIVE)
    assert list((tmp_path / "raw/n").glob("part-*"))
    assert into(**ARCHIVE) == 2 and into.read() == [1, 2]
    assert not list((tmp_path / "raw/n").glob("part-*"))


def test_files_that_an_earlier_run_did_not_move(spark, table_run, into, tmp_path, monkeypatch):
    arrive(spark, table_run, 1)
    monkeypatch.setattr(ingest_module, "archive_taken", lambda *more: 0)
    assert into(**ARCHIVE) == 1
    monkeypatch.undo()
    arrive(spark, table_run, 2)
    assert into(**ARCHIVE) == 1 and into.read() == [1, 2]
    assert not list((tmp_path / "raw/n").glob("part-*"))


def test_an_archive_needs_records(spark, table_run):
    with pytest.raises(ValueError, match="archive goes with"):
        open_datasets(spark, {"output": {"n": {**TARGET, "archive": "a"}}}, table_run)


def test_streams_and_batches_have_outputs_of_their_own(spark, run):
    spark.range(3).write.parquet(run.location("raw/n"))
    specs = {"input": {"n": FILES}, "output": {"n": TARGET, "m": {"type": "path", "path": "m"}}}
    inputs, outputs = open_datasets(spark, specs, run)
    for name, df in (("m", inputs.read("n")), ("n", spark.range(3))):
        with pytest.raises(ValueError, match="output of type stream"):
            outputs.write(name, df)
