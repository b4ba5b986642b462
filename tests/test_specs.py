from __future__ import annotations

import pytest

from layerline import RunContext
from layerline.sources.groups import _resolve

RUN = RunContext(warehouse="s3a://lake/", catalog="hub", env="local", ymd="2023-11-05", hms="041907")


def resolve(spec, kind="input", run=RUN):
    return _resolve("it", spec, run, kind)


def test_path_is_joined_to_the_warehouse_with_one_slash():
    dataset = resolve({"type": "path", "path": "/raw/trips"})
    assert dataset.location == "s3a://lake/raw/trips"
    assert dataset.format == "parquet"


def test_path_output_defaults_and_spec():
    spec = {"type": "path", "path": "mart/clicks/by_hour/ymd={ymd}", "format": "parquet", "mode": "overwrite"}
    dataset = resolve(spec, "output")
    assert dataset.location == "s3a://lake/mart/clicks/by_hour/ymd=2023-11-05"
    assert (dataset.format, dataset.mode, dataset.spec) == ("parquet", "overwrite", spec)
    assert resolve({"type": "path", "path": "x"}, "output").mode == "overwrite"


def test_all_templates():
    assert resolve({"type": "path", "path": "{env}/{ymd}/{hms}"}).location == "s3a://lake/local/2023-11-05/041907"


def test_table_by_path_has_a_location_and_the_iceberg_default():
    dataset = resolve({"type": "table", "path": "raw/clicks/ymd={ymd}"})
    assert dataset.location == "s3a://lake/raw/clicks/ymd=2023-11-05"
    assert (dataset.type, dataset.by_path, dataset.format) == ("table", True, "iceberg")


def test_table_wins_over_path():
    dataset = resolve({"type": "table", "table": "raw.trips", "path": "raw/trips"})
    assert (dataset.location, dataset.by_path) == ("hub.raw.trips", False)


@pytest.mark.parametrize("table", ["refined.city.trips", "hub.refined.city.trips"])
def test_catalog_is_put_in_front_once(table):
    assert resolve({"type": "table", "table": table}).location == "hub.refined.city.trips"


def test_no_catalog_leaves_the_name():
    run = RunContext(warehouse="s3a://lake")
    assert resolve({"type": "table", "table": "raw.trips"}, run=run).location == "raw.trips"


def test_templates_do_not_apply_to_table_names():
    assert resolve({"type": "table", "table": "raw.{ymd}"}).location == "hub.raw.{ymd}"


def test_session_catalog_namespaces_are_flattened():
    run = RunContext(catalog="spark_catalog")
    assert run.table_name("refined.city.trips") == "spark_catalog.refined__city.trips"
    assert run.table_name("spark_catalog.refined.city.trips") == "spark_catalog.refined__city.trips"
    assert run.table_name("raw.trips") == "spark_catalog.raw.trips"
    with pytest.raises(ValueError, match="reserved"):
        run.table_name("refined__city.x.orders")


def test_options_become_text():
    spec = {"type": "path", "path": "x", "options": {"header": True, "maxColumns": 5}}
    assert resolve(spec).options == {"header": "true", "maxColumns": "5"}


@pytest.mark.parametrize(
    ("spec", "message"),
    [
        ({"owner": "clicks"}, "no 'type'"),
        ({"type": "kafka", "path": "x"}, "type 'kafka' is none of"),
        ({"type": "path"}, "no 'path'"),
        ({"type": "table"}, "neither 'table' nor 'path'"),
        ("raw/trips", "a spec is a mapping"),
        ({"type": "path", "path": "x/{day}"}, "'it': no value for {day}"),
        ({"type": "path", "path": "x/{}"}, "bad template"),
        ({"type": "path", "path": "x", "options": ["header"]}, "options are a mapping"),
        ({"type": "path", "path": "x", "rebalance": "no"}, "rebalance is true, false or a number"),
        ({"type": "table", "table": "raw.trips", "format": "orc"}, "'format'"),
        ({"type": "table", "table": "raw.trips", "partition_by": ["x"]}, "'partition_by'"),
        ({"type": "table", "table": "raw.trips", "options": {"a": 1}}, "'options'"),
    ],
)
def test_bad_specs(spec, message):
    with pytest.raises(ValueError, match=message):
        resolve(spec)


@pytest.mark.parametrize("mode", [None, "overwrite", "bogus"])
def test_catalog_output_needs_a_table_mode(mode):
    spec = {"type": "table", "table": "raw.trips"} | ({"mode": mode} if mode else {})
    with pytest.raises(ValueError, match="append.*overwrite_partitions"):
        resolve(spec, "output")
    assert resolve(spec, "input").location == "hub.raw.trips"


def test_path_output_mode_is_checked():
    with pytest.raises(ValueError, match="bogus"):
        resolve({"type": "path", "path": "x", "mode": "bogus"}, "output")


def test_path_needs_a_warehouse():
    with pytest.raises(ValueError, match="no warehouse"):
        resolve({"type": "path", "path": "mart/out"}, run=RunContext())


def test_template_without_run_coordinates():
    with pytest.raises(ValueError, match="no value for {ymd}"):
        resolve({"type": "path", "path": "x/{ymd}"}, run=RunContext(warehouse="s3a://lake"))


@pytest.mark.parametrize("ymd", ["2023-11-5", "20231105", "2023-02-30", "today"])
def test_ymd_format(ymd):
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        RunContext(ymd=ymd)


@pytest.mark.parametrize("hms", ["04:19:07", "250000", "0419"])
def test_hms_format(hms):
    with pytest.raises(ValueError, match="HHMMSS"):
        RunContext(hms=hms)


def test_batch_needs_both_coordinates():
    RunContext(ymd="2023-11-05", hms="000101").require_batch()
    with pytest.raises(ValueError, match="both"):
        RunContext(ymd="2023-11-05").require_batch()


def test_run_from_config():
    config = {"catalog": {"name": "hub"}, "datasets": {"warehouse": "s3a://lake"}}
    assert RunContext.from_config(config, "local") == RunContext(warehouse="s3a://lake", catalog="hub")
    assert RunContext.from_config({"catalog": {"default": "c"}}, "aws") == RunContext(catalog="c", env="aws")
