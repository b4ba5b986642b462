from __future__ import annotations

import subprocess
import sys
from pathlib import Path
from unittest.mock import MagicMock

import pytest

from layerline.sources.folders import folder_exists, full_location, remove_folder, staging_folder

REPO = Path(__file__).resolve().parents[1]


def test_folders_are_new_and_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = staging_folder(spark, "x"), staging_folder(spark, "x")
    assert one != two
    assert one.startswith(f"{shared}/layerline-x-")
    assert folder_exists(spark, one)
    assert not folder_exists(spark, f"{one}/nothing")


def test_two_spellings_of_a_folder_are_one(spark, tmp_path):
    assert full_location(spark, f"{tmp_path}/land/../land/") == full_location(spark, f"file://{tmp_path}/land")


def test_folders_are_removed(spark):
    folder = staging_folder(spark, "x")
    remove_folder(spark, folder)
    assert not folder_exists(spark, folder)


def test_no_folder_is_made_up():
    spark = MagicMock()
    spark.conf.get = lambda key, default=None: default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_folder(spark, "x")


def test_staged_data_goes_with_the_application(tmp_path):
    script = f"""
import sys; sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
from layerline.sources.folders import staging_folder
spark = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
folder = staging_folder(spark, "x")
spark.range(3).write.parquet(folder + "/n")
print(spark.read.parquet(folder + "/n").count())
"""
    ran = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert ran.stdout.strip() == "3", ran.stderr
    assert not list(tmp_path.glob("layerline-*"))
