"""Tables stored as folders of part files, and running away from the
repository."""

import os
import subprocess
import sys
import tempfile

import pytest

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ORDER = {"events": ["ts", "event_id"], "orders": ["o_orderdate", "o_orderkey"], "lineitem": ["l_shipdate", "l_orderkey"]}


@pytest.fixture(scope="module")
def part_files(spark):
    """The smallest tables as four part files each, in time order."""
    from rivulet.plans.tables import TABLES

    base = tempfile.mkdtemp(prefix="rivulet-parts-")
    for i, name in enumerate(TABLES):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        out = f"{base}/{name}.parquet"
        df.orderBy(*ORDER.get(name, df.columns[:1])).coalesce(1).write.option(
            "maxRecordsPerFile", max(1, -(-df.count() // 4))).parquet(out)
        parts = sorted(f for f in os.listdir(out) if f.endswith(".parquet"))
        for j, f in enumerate(parts):  # a file source takes files by their time
            os.utime(f"{out}/{f}", (1_700_000_000 + 100 * j, 1_700_000_000 + 100 * j))
    return base


def test_every_query_reads_folders(spark, part_files):
    """All registered queries against their oracles on part files; streams
    take one file a micro-batch, so their state is read back."""
    import oracle_check

    from rivulet.plans import registry
    from rivulet.streaming.runner import FILES_PER_TRIGGER

    spark.conf.set(FILES_PER_TRIGGER, "1")
    try:
        res = oracle_check.check(spark, part_files, list(registry.queries()), verbose=False, pattern="/*.parquet")
    finally:
        spark.conf.unset(FILES_PER_TRIGGER)
    bad = {k: v for k, v in res.items() if v not in ("ok", "rows")}
    assert not bad, bad


def test_tasks_find_the_package_from_another_folder(tmp_dir):
    code = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for key in ("running_sum", "udaf_decimal_sum", "map_in_pandas_setup"):
    print(key, entry.queries()[key](s, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert len(out.stdout.split()) == 6


def test_a_cluster_must_name_a_shared_folder():
    from rivulet.session import local_folder

    assert os.path.isdir(local_folder("local[4]"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            local_folder(master)


def test_scratch_tables_can_be_dropped(spark):
    from rivulet.session import drop_scratch, written

    df = written(spark.range(5), "drop-me")
    path = df.inputFiles()[0]
    assert df.count() == 5 and drop_scratch(spark) >= 1
    assert not os.path.exists(path.removeprefix("file:").replace("//", "/"))
