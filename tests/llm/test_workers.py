"""Every operator with Python code, on workers that do not have the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tests.conftest import TESTDATA

REPO = Path(__file__).resolve().parents[2]
#: Workers look where PYTHONPATH says and in the folder they start in, not where the driver's program looks.
PROGRAM = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())
def found(_):
    try:
        import layerline
        return ["there"]
    except ImportError:
        return []
assert spark.sparkContext.parallelize([1], 1).mapPartitions(found).collect() == [], "the workers have the package"
import __spark_entry__
queries = __spark_entry__.queries()
for name in sys.argv[4:]:
    print(name, queries[name](spark, sys.argv[2]).count(), flush=True)
"""
NAMES = [
    "op2_token_files",
    "token_counts_word_bpe",
    "op4_language_id",
    "op5_decontamination",
    "op6_simhash_near_dedup",
    "op11_embedding_near_dedup",
    "op12_vector_codes",
    "op13_lexical_search",
    "pipeline",
]


@pytest.fixture(scope="module")
def printed(tmp_path_factory):
    away, shared = tmp_path_factory.mktemp("away"), tmp_path_factory.mktemp("shared")
    (away / "program.py").write_text(PROGRAM)
    paths = [path for path in os.environ.get("PYTHONPATH", "").split(":") if path and not (Path(path) / "layerline").exists()]
    done = subprocess.run(
        [sys.executable, away / "program.py", REPO, TESTDATA, shared, *NAMES],
        cwd=away,
        env=os.environ | {"PYTHONPATH": ":".join(paths), "SPARK_LOCAL_IP": "127.0.0.1"},
        capture_output=True,
        text=True,
        timeout=900,
    )
    return done.stdout + done.stderr[-3000:]


@pytest.mark.parametrize("name", NAMES)
def test_code_travels_with_the_plan(printed, name):
    assert f"\n{name} " in "\n" + printed, printed[-3000:]
