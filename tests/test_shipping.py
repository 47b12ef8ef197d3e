"""Functions that run in Python workers reach them without the package: a session
started in another folder, where only the driver has the repository on its path."""

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from kiln.operators import boost, tree  # noqa: F401
import kiln.plans
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
def absent(batches):
    import importlib.util
    assert importlib.util.find_spec("kiln") is None
    yield from batches
assert spark.range(4).mapInArrow(absent, "id long").count() == 4
{body}
print("done")
"""


def run_elsewhere(tmp_path, body):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, body=body)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and done.stdout.strip().endswith("done"), done.stderr[-3000:]


def test_a_function_of_the_package_runs_in_workers(tmp_path):
    run_elsewhere(tmp_path, "")
