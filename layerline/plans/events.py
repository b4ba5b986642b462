"""Daily event summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerline.operators import group_totals
from layerline.sources import DatasetGroup, RunContext, read_dataset

# Partition columns are declared as text: inferred, ymd would come back as a date.
EVENT_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING, ymd STRING"
)
SUMMARY_SCHEMA = "event_type STRING, event_count BIGINT, total_value DOUBLE, ymd STRING"

# The place of the events and the names of the datasets. The rest is this repository's choice.
# One day: read its directory, replace its directory.
DAILY_SPECS = {
    "input": {"impression": {"type": "path", "path": "raw/events/impression/ymd={ymd}"}},
    "output": {"main": {"type": "path", "path": "mart/events/summary/ymd={ymd}", "mode": "overwrite"}},
}

# Every day there is, as one job: days without events keep the summary they have.
BACKFILL_SPECS = {
    "input": {"impression": {"type": "path", "path": "raw/events/impression", "schema": EVENT_SCHEMA}},
    "output": {
        "main": {
            "type": "path",
            "path": "mart/events/summary",
            "mode": "overwrite",
            "partition_by": ["ymd"],
            "options": {"partitionOverwriteMode": "dynamic"},
            "schema": SUMMARY_SCHEMA,
        }
    },
}


def events_daily(spark: SparkSession, inputs: DatasetGroup, outputs: DatasetGroup, run: RunContext) -> DataFrame:
    """Summary by event type of the run's day."""
    run.require_batch()
    outputs.write("main", _totals(inputs.read("impression"), "event_type"))
    return read_dataset(spark, outputs["main"])


def events_backfill(spark: SparkSession, inputs: DatasetGroup, outputs: DatasetGroup, run: RunContext) -> DataFrame:
    """Summary by day and event type of all days."""
    run.require_batch()
    outputs.write("main", _totals(inputs.read("impression"), "ymd", "event_type"))
    return read_dataset(spark, outputs["main"])


def _totals(events: DataFrame, *keys: str) -> DataFrame:
    return group_totals(events, *keys, total_of="value", count_as="event_count", total_as="total_value")
