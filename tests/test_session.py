"""Folders that a job makes are gone when its application ends."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

JOB = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from shelfwatch.session import get_session, scratch_folder
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", sys.argv[2]).getOrCreate()
path = scratch_folder(get_session(), "run")
spark.range(3).write.parquet(path + "/data")
assert spark.read.parquet(path + "/data").count() == 3
spark.range(3).write.parquet(sys.argv[2] + "/kept")
"""


def test_scratch_folders_end_with_the_application(tmp_root):
    subprocess.run([sys.executable, "-c", JOB, ROOT, tmp_root], check=True, timeout=300, capture_output=True)
    found = [n for _, names, _ in os.walk(tmp_root) for n in names]
    assert "kept" in found and not [n for n in found if n.startswith("run-")]
