"""Python tasks run where the package is not installed."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
PROGRAM = """
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
print("batches", entry.queries()["q_batches_bytes"](spark, "/root/testdata/sf0.001").count())
"""


def test_tasks_need_no_package_on_the_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", PROGRAM.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=150)
    assert "batches " in out.stdout, out.stderr[-2000:]
