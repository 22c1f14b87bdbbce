import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rivulet.operators import text as TX
from rivulet.streaming import runner as S


def _write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_word_count_survives_restart(spark, tmp_dir):
    """Checkpointed streaming word count stopped between batches and
    restarted equals the batch word count (no loss, no double count)."""
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _write_lines(src, "1.txt", ["spark storm", " spark  hive "])

    def run():
        lines = spark.readStream.schema("value string").text(src).withColumnRenamed("value", "line")
        counts = TX.word_count(TX.flat_map_words(lines))
        return S.run_update(counts, "wc", ["word"], checkpoint=ckpt, path=out)

    first = rows(run())
    assert first == [("hive", 1), ("spark", 2), ("storm", 1)]
    _write_lines(src, "2.txt", ["spark hbase", ""])
    second = rows(run())
    assert second == [("hbase", 1), ("hive", 1), ("spark", 3), ("storm", 1)]
    batch = rows(TX.word_count(TX.flat_map_words(spark.read.text(src).withColumnRenamed("value", "line"))))
    assert second == batch


def test_dedup_within_watermark(spark, tmp_dir):
    from rivulet.sinks.kafka import dedup_replay

    src = f"{tmp_dir}/ev"
    _write_lines(src, "a.json", ['{"id": 1, "ts": "2024-01-01 00:00:00"}', '{"id": 2, "ts": "2024-01-01 00:00:01"}'])
    _write_lines(src, "b.json", ['{"id": 1, "ts": "2024-01-01 00:00:00"}'])  # replayed message
    st = spark.readStream.schema("id long, ts timestamp").json(src)
    got = S.run_append(dedup_replay(st, ["id"], "ts", "1 minute"), "dedup", path=f"{tmp_dir}/o",
                       checkpoint=f"{tmp_dir}/c")
    assert rows(got, "id") == [(1,), (2,)]


@pytest.mark.skipif(not os.environ.get("RIVULET_TEST_DERBY"), reason="starts a database")
def test_foreach_batch_jdbc_upsert(spark, tmp_dir):
    from rivulet.sinks import jdbc as JD

    url = "jdbc:derby:memory:rivulet_stream;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    JD.execute(spark, url, ["CREATE TABLE city_total (CITY VARCHAR(50) PRIMARY KEY, AMOUNT DECIMAL(28,2))"], props)
    src = f"{tmp_dir}/orders"
    _write_lines(src, "1.json", ['{"city": "a", "money": 1.5}', '{"city": "b", "money": 2.25}'])
    st = spark.readStream.schema("city string, money double").json(src)
    agg = st.groupBy(F.col("city").alias("CITY")).agg(
        F.sum(F.col("money").cast("decimal(18,2)")).cast("decimal(28,2)").alias("AMOUNT"))
    q = (agg.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_dir}/ck")
         .foreachBatch(JD.upsert_each_batch(url, "city_total", ["CITY"], props, job="city"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    _write_lines(src, "2.json", ['{"city": "a", "money": 1.0}'])
    q = (agg.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_dir}/ck")
         .foreachBatch(JD.upsert_each_batch(url, "city_total", ["CITY"], props, job="city"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = JD.query_rows(spark, url, "SELECT CITY, AMOUNT FROM city_total", props)
    assert [(c, str(a)) for c, a in rows(got)] == [("a", "2.50"), ("b", "2.25")]
    # per-record sink (K6): every input row appended
    JD.execute(spark, url, ["CREATE TABLE raw_orders (CITY VARCHAR(50), MONEY DOUBLE)"], props)
    q = (st.select(F.col("city").alias("CITY"), F.col("money").alias("MONEY")).writeStream
         .option("checkpointLocation", f"{tmp_dir}/ck2").foreachBatch(JD.append_each_batch(url, "raw_orders", props))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert JD.query_rows(spark, url, "SELECT COUNT(*) AS n FROM raw_orders", props).first()[0] == 3


def test_dimension_refreshed_per_batch(spark, tmp_dir):
    """The dimension files are read again for every micro-batch; a row
    sees the latest version written before its batch, or null."""
    from rivulet.streaming.dimension import enrich_each_batch

    src, out, dim = f"{tmp_dir}/track", f"{tmp_dir}/enriched", f"{tmp_dir}/dim"
    sink = lambda df, bid: df.write.mode("append").parquet(out)
    entries = "USERID string, USERNAME string, VER int"
    spark.createDataFrame([("u1", "alice", 1)], entries).write.parquet(dim)

    def run():
        st = spark.readStream.schema("USERID string, item int").json(src)
        load = lambda: spark.read.schema(entries).parquet(dim)
        q = (st.writeStream.foreachBatch(enrich_each_batch(load, ["USERID"], sink, version="VER"))
             .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
        q.awaitTermination()

    _write_lines(src, "1.json", ['{"USERID": "u1", "item": 1}', '{"USERID": "u2", "item": 2}'])
    run()
    spark.createDataFrame([("u1", "alice2", 2), ("u2", "bob", 1)], entries).write.mode("append").parquet(dim)
    _write_lines(src, "2.json", ['{"USERID": "u1", "item": 3}', '{"USERID": "u2", "item": 4}'])
    run()
    got = rows(spark.read.parquet(out), "item", "USERNAME")
    assert got == [(1, "alice"), (2, None), (3, "alice2"), (4, "bob")]


def test_running_max_keeps_nulls_and_bigints(spark, tmp_dir):
    """10, null, then 5 in the next batch gives 10, 10, 10; a key without a
    value has no maximum; bigints above 2^53 stay exact."""
    from rivulet.streaming.stateful import keyed_running_max

    S.prepare(spark)
    src, big = f"{tmp_dir}/m", (1 << 60) + 1

    def run():
        st = spark.readStream.schema("k string, id long, ts long, v long").json(src)
        return S.run_append(keyed_running_max(st, "k", "id", "ts", "v"), "max", checkpoint=f"{tmp_dir}/c", path=f"{tmp_dir}/o")

    _write_lines(src, "1.json", ['{"k": "a", "id": 1, "ts": 1, "v": 10}', '{"k": "a", "id": 2, "ts": 2}',
                                 '{"k": "b", "id": 3, "ts": 1}', '{"k": "c", "id": 4, "ts": 1, "v": %d}' % big])
    run()
    _write_lines(src, "2.json", ['{"k": "a", "id": 5, "ts": 3, "v": 5}', '{"k": "b", "id": 6, "ts": 2, "v": -4}',
                                 '{"k": "c", "id": 7, "ts": 2, "v": %d}' % (big - 1)])
    got = {r["id"]: r["running_max"] for r in run().collect()}
    assert got == {1: 10, 2: 10, 3: None, 4: big, 5: 10, 6: -4, 7: big}


def test_stream_bucketed_files(spark, tmp_dir):
    """K8: streaming file sink with hour buckets from the record time."""
    from rivulet.streaming.dimension import stream_bucketed_files

    src = f"{tmp_dir}/lines"
    _write_lines(src, "a.json", ['{"id": 1, "ts": "2024-01-01 05:10:00"}', '{"id": 2, "ts": "2024-01-01 06:20:00"}'])
    st = spark.readStream.schema("id long, ts timestamp").json(src)
    q = stream_bucketed_files(st, f"{tmp_dir}/out", f"{tmp_dir}/ck", "ts")
    q.awaitTermination()
    dirs = sorted(d for d in os.listdir(f"{tmp_dir}/out") if d.startswith("bucket="))
    assert dirs == ["bucket=2024-01-01--05", "bucket=2024-01-01--06"]


def test_allowed_lateness_stream(spark, tmp_dir):
    """H8/H9 on a stream: fire at the watermark, re-fire per late row
    within the lateness, side output after it (watermark per micro-batch)."""
    from rivulet.streaming.stateful import allowed_lateness

    S.prepare(spark)
    src = f"{tmp_dir}/gate"
    # window 10 s, watermark delay 0, lateness 5 s; one file per micro-batch
    _write_lines(src, "1.json", ['{"id": 1, "t": 1, "v": 1}', '{"id": 2, "t": 12, "v": 2}'])
    _write_lines(src, "2.json", ['{"id": 3, "t": 8, "v": 3}', '{"id": 4, "t": 16, "v": 4}'])
    _write_lines(src, "3.json", ['{"id": 5, "t": 3, "v": 5}', '{"id": 6, "t": 30, "v": 6}'])
    for i, name in enumerate(["1.json", "2.json", "3.json"]):  # file source order = modification time
        os.utime(f"{src}/{name}", (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    st = (spark.readStream.schema("id long, t long, v long").option("maxFilesPerTrigger", 1).json(src)
          .withColumn("ts", F.timestamp_seconds("t")).withColumn("ts_ms", F.col("t") * 1000)
          .withColumn("k", F.lit("gate")).withWatermark("ts", "0 seconds")
          .select("k", "ts_ms", "v", "id"))
    res = S.run_append(allowed_lateness(st, "k", "ts_ms", "v", "id", 10, 5), "late",
                       path=f"{tmp_dir}/o", checkpoint=f"{tmp_dir}/c")
    got = [tuple(r) for r in res.select("kind", "win_start", "total", "event_id").collect()]
    # batch 1: wm 0; no-data batch: wm 12 fires [0,10) = 1
    # batch 2 (wm 12): id 3 late for [0,10) → 4; id 4 in [10,20)
    # batch 3 (wm 16): id 5 at 3 s: 10 + 5 <= 16 → side output; then wm 30 fires [10,20) = 6
    assert ("fire", 0, 1, None) in got
    assert ("late_fire", 0, 4, 3) in got
    assert ("side", 0, None, 5) in got
    assert ("fire", 10000, 6, None) in got


def test_processing_time_trigger_runner(spark, tmp_dir):
    """Periodic trigger; the runner stops once the input is processed."""
    src = f"{tmp_dir}/p"
    _write_lines(src, "a.json", ['{"id": 1}', '{"id": 2}'])
    st = spark.readStream.schema("id long").json(src)
    got = S.run_append(st, "periodic", path=f"{tmp_dir}/o", checkpoint=f"{tmp_dir}/c",
                       available_now=False, processing_time="200 milliseconds")
    assert rows(got) == [(1,), (2,)]


def test_micro_batches_of_a_hot_key_are_bounded(spark, monkeypatch):
    import datetime as dt
    from types import SimpleNamespace

    from conftest import SF_SMALL
    from rivulet.plans import q_stream as Q
    from tools.oracle_check import check

    start = dt.datetime(2024, 1, 1)
    data = [(i, 7, start + dt.timedelta(seconds=(i * 37) % 800, microseconds=i), "view", float((i * 31) % 101)) for i in range(800)]
    ev = spark.createDataFrame(data, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double")
    t = SimpleNamespace(spark=spark, events=ev.repartition(3), sf_dir="none")
    batches = []
    run = S.run_append

    def seen(*args, **options):
        out = run(*args, **options)
        batches.append(out.count())
        return out

    monkeypatch.setattr(S, "run_append", seen)
    spark.conf.set(S.ROWS_PER_BATCH, "200")
    try:
        order = sorted(data, key=lambda r: (r[2], r[0]))
        assert rows(Q.stream_keyed_counter(t)) == sorted((r[0], 7, i + 1) for i, r in enumerate(order))
        sizes = [b - a for a, b in zip([0, *batches], batches)]
        assert len(sizes) == 4 and max(sizes) < 400
        best = [max(r[4] for r in order[:i + 1]) for i in range(len(order))]
        assert rows(Q.stream_running_max(t)) == sorted((r[0], 7, m) for r, m in zip(order, best))
        batches.clear()
        keys = ["stream_keyed_counter", "stream_running_max", "stream_order_timeout"]
        assert set(check(spark, SF_SMALL, keys, verbose=False).values()) == {"ok"} and len(batches) > 6
    finally:
        spark.conf.unset(S.ROWS_PER_BATCH)


def test_allowed_lateness_state_is_keyed_by_window(spark, tmp_dir):
    from rivulet.streaming.stateful import allowed_lateness

    st = spark.readStream.schema("id long, t long, v long").json(tmp_dir)
    st = st.select(F.lit("k").alias("k"), "id", "v", (F.col("t") * 1000).alias("ms"), F.timestamp_seconds("t").alias("ts"))
    out = allowed_lateness(st.withWatermark("ts", "0 seconds"), "k", "ms", "v", "id", 10, 5)
    assert "__win" in out._jdf.queryExecution().analyzed().toString().split("TransformWithState")[1]


def test_lateness_quarters_arrive_as_many_files(spark):
    import glob
    from types import SimpleNamespace

    from conftest import SF_SMALL
    from rivulet import session
    from rivulet.plans import q_stream as Q

    before = set(session._SCRATCH)
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(4)
    assert Q.stream_allowed_lateness(SimpleNamespace(spark=spark, events=events, sf_dir=SF_SMALL)).count() > 0
    source, = [x for x in set(session._SCRATCH) - before if "late-in" in x]
    source = source.removeprefix("file:")
    assert len(glob.glob(f"{source}/**/*.parquet", recursive=True)) >= 16
