"""Overwrites that leave the old rows where they fail."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from layerline import open_datasets
from layerline.sources import swap
from tests.conftest import rows

SPEC = {"type": "path", "path": "day/ymd={ymd}", "swap": True}


@pytest.fixture
def days(spark, store):
    write, read = store(SPEC)
    write(spark.range(3))
    return write, read


def names(tmp_path):
    return sorted(one.name for one in (tmp_path / "day").iterdir())


def test_rows_are_replaced(spark, days, tmp_path):
    write, read = days
    assert write(spark.range(5), count_rows=True) == 5
    assert rows(read()) == [(i,) for i in range(5)]
    assert names(tmp_path) == ["ymd=2023-11-05"]


def test_a_write_that_fails_leaves_the_old_rows(spark, days, run):
    write, read = days
    broken = spark.range(0, 50, 1, 5).select(F.when(F.col("id") == 49, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write(broken)
    assert rows(read()) == [(0,), (1,), (2,)]
    # Nor do readers of all days see what was begun.
    assert spark.read.parquet(run.location("day")).count() == 3
    write(spark.range(7))
    assert read().count() == 7


def test_without_it_a_failed_write_has_deleted_them(spark, store):
    """What the option is for."""
    write, read = store({**SPEC, "swap": False})
    write(spark.range(3))
    with pytest.raises(Exception, match="stop"):
        write(spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id")))
    with pytest.raises(Exception, match="(?i)unable to infer|does not exist|UNABLE_TO_INFER"):
        read().count()


@pytest.mark.parametrize(("step", "left"), [(0, 3), (1, 3), (2, 5), (3, 5)])
def test_a_run_that_ends_between_the_steps(spark, days, monkeypatch, tmp_path, step, left):
    """0 before anything is renamed, 1 before the old rows go, 2 before the new ones come, 3 before the old are deleted."""
    write, read = days
    done, before, drop = [], swap.move, swap.remove_folder

    def move(*names):
        if len(done) == step:
            raise KeyboardInterrupt
        done.append(names)
        before(*names)

    def remove(session, folder):
        if len(done) == step == 3:
            raise KeyboardInterrupt
        drop(session, folder)

    monkeypatch.setattr(swap, "move", move)
    monkeypatch.setattr(swap, "remove_folder", remove)
    with pytest.raises(KeyboardInterrupt):
        write(spark.range(5))
    monkeypatch.setattr(swap, "move", before)
    monkeypatch.setattr(swap, "remove_folder", drop)
    assert read().count() == left
    write(spark.range(9))
    assert read().count() == 9 and names(tmp_path) == ["ymd=2023-11-05"]


def test_rows_may_come_from_the_place_they_replace(days):
    write, read = days
    write(read().where("id > 0"))
    assert rows(read()) == [(1,), (2,)]


def test_directories_are_replaced_whole(spark, store, tmp_path):
    write, read = store({"type": "path", "path": "t", "swap": True, "partition_by": ["k"], "schema": "id BIGINT, k STRING"})
    write(spark.range(4).withColumn("k", F.col("id").cast("string")))
    write(spark.range(1).withColumn("k", F.lit("0")))
    assert rows(read()) == [(0, "0")]


@pytest.mark.parametrize("change", [{"mode": "append"}, {"options": {"partitionOverwriteMode": "dynamic"}}])
def test_only_whole_overwrites(spark, run, change):
    with pytest.raises(ValueError, match="swap is for"):
        open_datasets(spark, {"output": {"t": {**SPEC, **change}}}, run)
