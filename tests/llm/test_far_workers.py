"""Operators where only the driver can import the library: what tasks run must come with the job."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def importable(rows):
    import importlib.util
    yield importlib.util.find_spec("tallyloom") is not None

assert not any(spark.sparkContext.parallelize(range(4), 4).mapPartitions(importable).collect())
sys.path.insert(0, sys.argv[2])
from tallyloom.llm.queries import QUERIES
for name, query in QUERIES.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("done", name, flush=True)
"""


def test_workers_need_no_copy_of_the_library(tmp_path):
    script = tmp_path / "outside.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, str(script), str(tmp_path / "shared"), str(REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False)
    assert ran.returncode == 0, ran.stderr[-3000:]
    assert ran.stdout.count("done op") == 13
