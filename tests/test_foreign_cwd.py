"""The driver may import the entry module by path from another working directory;
Python workers must then still run the search kernel and pandas embedders."""

import os
import subprocess
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
print("ROWS", len(e.queries()["topk_dense"](spark, {SF!r}).toPandas()))
"""


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_entry_runs_from_another_directory():
    with tempfile.TemporaryDirectory() as cwd:
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                           text=True, timeout=600)
    assert "ROWS 75\n" in r.stdout, r.stderr[-2000:]
