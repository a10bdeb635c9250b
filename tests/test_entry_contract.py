"""The driver imports __spark_entry__ from elsewhere with its own plain session: the Python
workers must still import the package (shipped with addPyFile)."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.ui.enabled", "false").getOrCreate())
import __spark_entry__ as E
assert len(E.entry(spark).collect()) > 0
rows = E.queries()["daily_arrow_grouped"](spark, "/root/testdata/sf0.001").collect()
print("ROWS", len(rows))
"""


def test_queries_run_from_another_directory_with_a_plain_session():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 30" in out.stdout, out.stderr[-3000:]
