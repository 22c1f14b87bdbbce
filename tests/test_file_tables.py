"""Keyed table, transactional sink and log source: replays, failures, restarts."""

import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rivulet.sinks import transactional as X
from rivulet.sinks.keyed_table import KeyedTable
from rivulet.sources.log_stream import append_segments, log_stream
from rivulet.streaming import runner as S

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_keyed_table_equals_a_dictionary(spark, tmp_dir):
    rng, want = random.Random(4), {}
    table = KeyedTable(spark, f"{tmp_dir}/t", ["a", "b"], buckets=4, max_deltas=2, order="v")
    for batch in range(6):
        new = [(rng.choice([None, 1, 2, 3]), rng.choice(["x", None, "y"]), rng.randint(0, 9), rng.choice([None, "p", "q"]))
               for _ in range(rng.choice([0, 1, 12]) if batch else 12)]
        df = spark.createDataFrame(new, "a long, b string, v long, note string")
        best = {}
        for a, b, v, note in new:
            best[a, b] = max(best.get((a, b), (-1, "")), (v, note or ""))
        want.update(best)
        assert table.upsert(df, batch_id=batch)
        before = table.manifest()
        assert not table.upsert(df.withColumn("v", F.lit(99).cast("long")), batch_id=batch)  # a replay
        assert table.manifest() == before
        got = {(r.a, r.b): (r.v, r.note or "") for r in table.read().collect()}
        assert got == want and table.read().count() == len(want)
        assert all(len(x) <= 3 for x in before["parts"].values())
    assert table.manifest()["version"] == 6 and table.manifest()["jobs"] == {"default": 5}


def test_keyed_table_touches_few_buckets(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", ["k"], buckets=16)
    table.upsert(spark.range(1000).selectExpr("id AS k", "id AS v"))
    old = table.manifest()["parts"]
    table.upsert(spark.createDataFrame([(7, -7)], "k long, v long"))
    new = table.manifest()["parts"]
    assert sum(new[b] != old[b] for b in new) == 1
    assert rows(table.read().where("k < 9"), "v") == sorted((k if k != 7 else -7,) for k in range(9))
    assert table.read(1).where("v < 0").count() == 0  # earlier versions stay readable
    for i in range(6):
        table.upsert(spark.createDataFrame([(7, i)], "k long, v long"))
    assert table.vacuum(keep=1) > 0 and table.read().count() == 1000
    assert table.read().where("k = 7").first().v == 5
    with pytest.raises(Exception):
        table.read(1).count()


def test_keyed_table_has_one_writer(spark, tmp_dir, monkeypatch):
    a, b = (KeyedTable(spark, f"{tmp_dir}/t", ["k"]) for _ in range(2))
    a.upsert(spark.range(3).selectExpr("id AS k"))  # keys only
    late = b.manifest()
    a.upsert(spark.range(5).selectExpr("id AS k"))
    monkeypatch.setattr(b, "manifest", lambda version=None: late)
    with pytest.raises(RuntimeError):
        b.upsert(spark.range(9).selectExpr("id AS k"))
    assert a.read().count() == 5
    with pytest.raises(ValueError):
        KeyedTable(spark, f"{tmp_dir}/t", ["other"]).upsert(spark.range(1).selectExpr("id AS k"))
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, f"{tmp_dir}/none", ["k"]).read()


def _sink_stream(spark, source, out, ck, fail_on=None):
    def check(batches):
        for b in batches:
            if fail_on is not None and fail_on in b.column("id").to_pylist():
                raise RuntimeError("planned failure")
            yield b

    X.register(spark)
    st = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    q = st.mapInArrow(check, "id long").writeStream.format(X.FORMAT).option("path", out).option("countBy", "id") \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - the planned failure
        return False
    return True


def test_failed_and_replayed_batches_of_the_transactional_sink(spark, tmp_dir):
    source, out, ck = (f"{tmp_dir}/{x}" for x in ("in", "out", "ck"))
    for i in range(3):
        spark.range(i * 100, i * 100 + 100, numPartitions=1).write.mode("append").parquet(source)
        os.utime(max((os.path.join(source, f) for f in os.listdir(source) if f.endswith(".parquet")), key=os.path.getmtime))
    assert not _sink_stream(spark, source, out, ck, fail_on=250)
    done = X.read_committed(spark, out, spark.range(1).schema).count()
    assert done == 100 * len(X.manifests(spark, out)) < 300
    open(f"{out}/data/lost.parquet", "w").close()  # as a lost task would leave it
    assert _sink_stream(spark, source, out, ck)
    assert rows(X.read_committed(spark, out, spark.range(1).schema)) == [(i,) for i in range(300)]
    last = max(int(n) for n in os.listdir(f"{ck}/commits") if n.isdigit())
    os.remove(f"{ck}/commits/.{last}.crc")
    os.remove(f"{ck}/commits/{last}")  # Spark does not know that the last batch was done, and runs it again
    assert _sink_stream(spark, source, out, ck)
    assert rows(X.read_committed(spark, out, spark.range(1).schema)) == [(i,) for i in range(300)]
    assert set(X.committed_counts(spark, out).values()) == {1}
    assert X.remove_unpublished(spark, out) == 1
    assert rows(X.read_committed(spark, out, spark.range(1).schema)) == [(i,) for i in range(300)]


def test_a_retried_task_counts_once(tmp_dir):
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark import TaskContext
from rivulet.session import local_session
from rivulet.sinks import transactional as X
s = local_session(2, extra={{"spark.master": "local[2,3]"}})
X.register(s)
src, out = {tmp_dir!r} + "/in", {tmp_dir!r} + "/out"
s.range(0, 1000, numPartitions=4).selectExpr("id", "id % 3 AS k").write.parquet(src)
def once(batches):
    for b in batches:
        yield b
        if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 0:
            raise RuntimeError("first attempt")
st = s.readStream.schema("id long, k long").parquet(src).mapInArrow(once, "id long, k long")
st.writeStream.format(X.FORMAT).option("path", out).option("countBy", "k").option(
    "checkpointLocation", {tmp_dir!r} + "/ck").trigger(availableNow=True).start().awaitTermination()
print("COUNTS", sorted(X.committed_counts(s, out).items()), X.read_committed(s, out, s.read.parquet(src).schema).distinct().count())
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "COUNTS [(0, 334), (1, 333), (2, 333)] 1000" in run.stdout, run.stderr[-3000:]


LOG = "partition int, offset bigint, ts timestamp_ntz, value string"


def _segment(spark, path, partition, first, n):
    df = spark.range(first, first + n).selectExpr(
        f"CAST({partition} AS INT) AS partition", "id AS offset",
        "CAST(timestamp_seconds(1700000000 + id * 60) AS timestamp_ntz) AS ts", "CAST(id AS STRING) AS value")
    append_segments(df, path, 7)


def _drain(spark, path, out, ck, **options):
    st = log_stream(spark, path, spark.createDataFrame([], LOG).schema, **options).select("partition", "offset")
    got = S.run_append(st, "log", checkpoint=ck, path=out, available_now=False, processing_time="0 seconds")
    return rows(got)


def test_log_source_goes_on_from_its_checkpoint(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    _segment(spark, path, 0, 0, 20)
    _segment(spark, path, 1, 5, 20)
    want = [(0, i) for i in range(20)] + [(1, i) for i in range(5, 25)]
    assert _drain(spark, path, f"{tmp_dir}/o", f"{tmp_dir}/c", starting="earliest", max_offsets=6) == want
    with open(f"{tmp_dir}/c/offsets/0") as f:  # the first micro-batch took 6 offsets of each partition
        assert json.loads(f.read().splitlines()[-1]) == {"0": 6, "1": 11}
    _segment(spark, path, 0, 20, 10)
    _segment(spark, path, 2, 100, 4)  # a partition that appears later
    want = sorted(want + [(0, i) for i in range(20, 30)] + [(2, i) for i in range(100, 104)])
    assert _drain(spark, path, f"{tmp_dir}/o", f"{tmp_dir}/c", starting="latest", max_offsets=6) == want


def test_log_source_start_positions(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    _segment(spark, path, 0, 0, 20)
    _segment(spark, path, 1, 0, 20)

    def got(name, **options):
        return _drain(spark, path, f"{tmp_dir}/{name}", f"{tmp_dir}/{name}-ck", **options)

    assert got("offsets", starting="offsets", offsets={0: 15}) == [(0, i) for i in range(15, 20)]
    assert got("reset", starting="offsets", offsets={0: 15}, reset="earliest") == \
        [(0, i) for i in range(15, 20)] + [(1, i) for i in range(20)]
    at = "2023-11-14 22:31:20"  # 1700000000 is 22:13:20
    assert got("time", starting="timestamp", timestamp=at) == [(p, i) for p in (0, 1) for i in (18, 19)]
    assert got("late", starting="timestamp", timestamp="2030-01-01 00:00:00") == []
    assert got("beyond", starting="offsets", offsets={0: 50, 1: 19}) == [(1, 19)]
