import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_tasks_need_no_installation(tmp_dir):
    """All operators run from a folder that does not hold the package, with
    workers that cannot import it."""
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
for key in sorted(q for q in entry.queries() if q.startswith("op")):
    print(key, entry.queries()[key](s, "/root/testdata/sf0.001").count(), flush=True)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}

    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, (out.stdout, out.stderr[-2000:])
    assert len(out.stdout.split()) == 26
