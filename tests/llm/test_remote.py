"""Executors without a copy of the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())

@F.udf("boolean")
def importable(x):
    try:
        import tessera
        return True
    except ImportError:
        return False

assert spark.range(1).select(importable("id")).first()[0] is False
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as E
for name, q in E.queries().items():
    if name.startswith("op"):
        print(name, q(spark, sys.argv[2]).count(), flush=True)
print("all ran")
"""


def test_operators_run_where_workers_lack_the_package(tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "run.py", REPO, "/root/testdata/sf0.001", f"file://{tmp_path}/shared"], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stdout + done.stderr[-3000:]
    assert done.stdout.count("\n") >= 14
