"""The driver contract in a fresh process: plain SparkSession built by the
caller, package imported from another working directory."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as E
assert E.entry(spark).count() > 0
q = E.queries()
# clean_text goes through the Python UDF on the workers
assert q["clean_text"](spark, "/root/testdata/sf0.001").count() == 50
assert q["role_demand"](spark, "/root/testdata/sf0.001").count() > 0
print("CONTRACT_OK")
"""


def test_contract_in_fresh_process():
    cwd = tempfile.mkdtemp(prefix="hirescope-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert "CONTRACT_OK" in out.stdout, out.stderr[-3000:]
