"""Partitioned writes: few files, and no long task for a hot partition value."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

SCHEMA = "id BIGINT, s STRING, ymd STRING"


def files_by_day(folder):
    return {
        day: len([one for one in os.listdir(f"{folder}/{day}") if one.endswith(".parquet")])
        for day in os.listdir(folder)
        if day.startswith("ymd=")
    }


@pytest.fixture
def hot_day(spark):
    """A third of the rows, from all tasks, fall on one of 21 days."""
    day = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), (F.col("id") % 20)))
    return spark.range(0, 60000, 1, 12).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), day.alias("ymd"))


def test_small_days_are_one_file_each(store, tmp_path, hot_day):
    write, read = store({"type": "path", "path": "t", "partition_by": ["ymd"], "schema": SCHEMA})
    write(hot_day)
    assert set(files_by_day(f"{tmp_path}/t").values()) == {1}
    assert read().count() == 60000


def test_days_in_shuffle_partitions_of_their_own(store, tmp_path, hot_day, set_conf):
    """With few shuffle partitions, small days share one with the hot day and are split along with it."""
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    set_conf("spark.sql.shuffle.partitions", "2")
    files = {}
    for rebalance in (True, 500):
        spec = {"type": "path", "path": f"t{rebalance}", "partition_by": ["ymd"], "rebalance": rebalance}
        write, _ = store(spec)
        write(hot_day)
        files[rebalance] = files_by_day(f"{tmp_path}/t{rebalance}")
    assert sum(files[500].values()) < sum(files[True].values())
    assert files[500].pop("ymd=hot") > 3
    assert set(files[500].values()) == {1}


def test_gathering_needs_something_that_splits(store, hot_day, set_conf):
    set_conf("spark.sql.adaptive.enabled", "false")
    write, _ = store({"type": "path", "path": "t", "partition_by": ["ymd"]})
    with pytest.raises(ValueError, match="rebalance: false"):
        write(hot_day)


def test_without_gathering_each_task_writes_each_day(store, tmp_path, hot_day):
    write, _ = store({"type": "path", "path": "t", "partition_by": ["ymd"], "rebalance": False})
    write(hot_day)
    assert set(files_by_day(f"{tmp_path}/t").values()) == {12}


def test_a_hot_day_is_written_by_several_tasks(store, tmp_path, hot_day, set_conf):
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    write, read = store({"type": "path", "path": "t", "partition_by": ["ymd"], "schema": SCHEMA})
    assert write(hot_day, count_rows=True) == 60000
    assert files_by_day(f"{tmp_path}/t")["ymd=hot"] > 3
    assert read().agg(F.countDistinct("id")).first()[0] == 60000
