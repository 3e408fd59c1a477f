"""Python workers get the code of what they run; they need not find the package."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("names", [["op1_warc_archives", "op2_ogg_media", "op3_deleted_interpolation", "op5_pii_deobfuscation", "op6_chat_fingerprint_format"], ["op7_quality_classifier", "op9_minhash_neardup", "op10_token_histogram"]])
def test_workers_without_the_package(tmp_path, names):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as e
for name in {names!r}:
    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-2000:]
