from __future__ import annotations

import pytest

from layerline import Dataset, open_datasets
from layerline.sources import DATASET_TYPES, DatasetType
from tests.conftest import rows

SPECS = {
    "input": {"orders": {"type": "path", "path": "raw/orders"}},
    "output": {"main": {"type": "path", "path": "mart/main"}},
}


def test_groups_hold_what_they_were_given(spark, run):
    inputs, outputs = open_datasets(spark, {**SPECS, "warehouse": "unused"}, run)
    assert inputs["orders"].location == f"{run.warehouse}/raw/orders"
    assert list(inputs.resolved) == ["orders"]
    assert list(outputs.resolved) == ["main"]


def test_bad_specs_fail_before_any_read(spark, run):
    with pytest.raises(ValueError, match="no 'type'"):
        open_datasets(spark, {"input": {"bad": {"owner": "clicks"}}}, run)
    with pytest.raises(ValueError, match="'inputs'"):
        open_datasets(spark, {"inputs": {}}, run)


def test_reading_an_output_and_writing_an_input(spark, run):
    inputs, outputs = open_datasets(spark, SPECS, run)
    with pytest.raises(TypeError, match="not read"):
        outputs.read("main")
    with pytest.raises(TypeError, match="not written"):
        inputs.write("orders", spark.range(1))


def test_unknown_names_list_the_known_ones(spark, run):
    inputs, outputs = open_datasets(spark, SPECS, run)
    with pytest.raises(KeyError, match=r"no input dataset 'nope', only \['orders'\]"):
        inputs.read("nope")
    with pytest.raises(KeyError, match=r"no output dataset 'nope', only \['main'\]"):
        outputs.write("nope", spark.range(1))


def test_a_key_error_inside_a_dataset_is_not_a_missing_dataset(spark, run, monkeypatch):
    def broken(spark, dataset):
        raise KeyError("inner")

    monkeypatch.setitem(DATASET_TYPES, "path", DATASET_TYPES["path"]._replace(read=broken))
    with pytest.raises(KeyError, match="^'inner'$"):
        open_datasets(spark, SPECS, run)[0].read("orders")


def test_a_new_dataset_type_is_one_entry(spark, run, monkeypatch):
    def resolve(name, spec, run, kind):
        return Dataset(name=name, type="numbers", location=f"numbers:{spec['upto']}")

    monkeypatch.setitem(
        DATASET_TYPES,
        "numbers",
        DatasetType(resolve, lambda spark, one: spark.range(int(one.location.split(":")[1])), None),
    )
    inputs, _ = open_datasets(spark, {"input": {"n": {"type": "numbers", "upto": 3}}}, run)
    assert rows(inputs.read("n")) == [(0,), (1,), (2,)]


def test_other_environment(spark, run, tmp_path):
    environments = {"annex": {"warehouse": f"file://{tmp_path}/annex"}}
    inputs, outputs = open_datasets(
        spark, {"input": {"n": {"type": "path", "path": "n"}}, "output": {"n": {"type": "path", "path": "n"}}},
        run, environments,
    )
    outputs.write("n", spark.range(2))
    outputs("annex").write("n", spark.range(5))
    assert inputs.read("n").count() == 2
    assert inputs("annex").read("n").count() == 5
    assert inputs("annex")["n"].location == f"file://{tmp_path}/annex/n"
    assert inputs("annex") is inputs("annex")
    assert inputs("local") is inputs
    assert inputs("annex")("local")["n"].location == inputs["n"].location
    with pytest.raises(KeyError, match=r"'aws', only \['annex'\]"):
        inputs("aws")


@pytest.mark.parametrize("there", [{"warehouse": None}, {}, {"catalog": "other"}])
def test_an_environment_has_no_warehouse_but_its_own(spark, run, there):
    inputs, outputs = open_datasets(spark, SPECS, run, {"annex": there})
    for group in (inputs, outputs):
        with pytest.raises(ValueError, match="no warehouse"):
            group("annex")


def test_an_environment_has_no_catalog_but_its_own(spark, table_run, tmp_path):
    specs = {"input": {"orders": {"type": "table", "table": "raw.orders"}}}
    inputs, _ = open_datasets(spark, specs, table_run, {"annex": {"warehouse": f"file://{tmp_path}"}, "b": {"catalog": "x"}})
    assert inputs["orders"].location == "spark_catalog.raw.orders"
    with pytest.raises(ValueError, match="'orders': environment 'annex' names no catalog"):
        inputs("annex")
    assert inputs("b")["orders"].location == "x.raw.orders"


def test_an_environment_may_have_specs_of_its_own(spark, run, tmp_path):
    spark.range(4).write.orc(f"{tmp_path}/annex/other/place")
    spark.range(2).write.parquet(f"{tmp_path}/raw/orders")
    own = {"input": {"orders": {"type": "path", "path": "other/place", "format": "orc"}}}
    inputs, outputs = open_datasets(spark, SPECS, run, {"annex": {"warehouse": f"file://{tmp_path}/annex", "datasets": own}})
    assert inputs("annex").read("orders").count() == 4
    assert inputs("annex")("local").read("orders").count() == 2
    assert not outputs("annex").resolved


def test_unknown_keys_of_an_environment(spark, run):
    with pytest.raises(ValueError, match=r"environment 'annex'.*\['werehouse'\]"):
        open_datasets(spark, SPECS, run, {"annex": {"werehouse": "x"}})
