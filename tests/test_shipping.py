"""The package reaches Python workers even when the driver runs elsewhere."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util, sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "3").getOrCreate())
spec = importlib.util.spec_from_file_location("__spark_entry__", {REPO!r} + "/__spark_entry__.py")
mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(mod)
print("ROWS", mod.queries()["rank_in_group"](spark, "/root/testdata/sf0.01").count())
"""


def test_query_runs_from_another_working_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 517" in out.stdout, out.stderr[-2000:]
