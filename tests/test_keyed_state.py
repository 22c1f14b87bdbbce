"""State fed by streams of updates, and changelogs."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from rivulet.streaming import runner as S
from rivulet.streaming.broadcast_state import with_last_update
from rivulet.streaming.retract import replayed, retract_stream


def test_broadcast_state_over_batches_and_salts(spark):
    S.prepare(spark)
    rng, data = random.Random(5), []
    for i in range(900):  # a third of the rows have one key
        key = rng.choice(["hot", None, "", rng.choice("abcdef")])
        data.append((i, key, rng.randint(0, 400) * 1_000_000, rng.random() < 0.7, rng.choice([None, i, -i]), rng.choice([None, "é", "x"])))
    df = spark.createDataFrame(data, "id long, k string, us long, fact boolean, num long, txt string")
    df = df.withColumn("ts", F.timestamp_micros("us"))

    def build(st):
        return with_last_update(st, "k", "id", "us", "fact", ["num", "txt"], buckets=3, salts=2)

    got = {r.id: (r.k, r.num, r.txt) for r in S.run_in_time_order(df, "ts", build, "bc", min_batches=4).collect()}
    last, want = {}, {}
    for i, k, us, fact, num, txt in sorted(data, key=lambda r: (r[2], r[3], r[0])):
        if fact:
            want[i] = (k, *last.get(k, (None, None)))
        else:
            last[k] = (num, txt)
    assert got == want


def test_changelog_takes_back_what_it_gave(spark):
    S.prepare(spark)
    rng = random.Random(6)
    data = [(rng.choice(["a", "b", None]), i, rng.choice([None, 5, -5, 0])) for i in range(300)]
    df = spark.createDataFrame(data, "k string, us long, v long").withColumn("ts", F.timestamp_seconds("us"))
    out = S.run_in_time_order(df, "ts", lambda st: retract_stream(st, ["k"], "v"), "retract-test", min_batches=5)
    log = defaultdict(list)
    for r in out.collect():
        log[r.k].append((r.version, r.is_add, r.n, r.total))
    for k, changes in log.items():
        adds = {v: (n, t) for v, add, n, t in changes if add}
        backs = {v: (n, t) for v, add, n, t in changes if not add}
        assert set(backs) == set(adds) - {max(adds)} and all(adds[v] == x for v, x in backs.items())
        assert len(adds) > 2
    n, total = Counter(k for k, _, _ in data), Counter()
    for k, _, v in data:
        total[k] += v or 0
    got = {r.k: (r.n, r.total, r.open_rows, r.loose_retracts) for r in replayed(out, ["k"]).collect()}
    assert got == {k: (n[k], total[k], 1, 0) for k in n}


def test_cogroup_of_a_hot_window_in_chunks(spark):
    from rivulet.streaming.cogroup import window_cogroup

    def matches(key, win, left, right):
        """Left outer join of the chunks: every left row with the number of right rows of its kind."""
        import pandas as pd

        kinds = Counter()
        for c in right():
            assert len(c) <= 7
            kinds.update(c["kind"].tolist())
        for c in left():
            assert len(c) <= 7
            yield pd.DataFrame({"key": key, "win": win, "id": c["id"], "n": [kinds[k] for k in c["kind"]]})

    S.prepare(spark)
    rng, data = random.Random(9), []
    for i in range(400):
        key = rng.choice(["hot", "hot", "a", None])
        data.append((i, key, rng.choice([5, 5, 15, 25]) + rng.random() * 4, rng.random() < 0.6, rng.choice(["x", None, "é"])))
    data.append((999, "a", 100.0, True, "x"))  # moves the watermark past all windows but its own
    df = spark.createDataFrame(data, "id long, k string, s double, is_left boolean, kind string")
    df = df.withColumn("ts", F.timestamp_millis((F.col("s") * 1000).cast("long")))

    def build(st):
        return window_cogroup(st.withWatermark("ts", "0 seconds"), "k", "ts", "is_left", ["id", "kind"], ["kind"], 10, matches,
                              "key string, win bigint, id bigint, n bigint", salts=3, chunk=7)

    got = {r.id: (r.key, r.win, r.n) for r in S.run_in_time_order(df, "ts", build, "cogroup", min_batches=3).collect()}
    want = {}
    for i, k, s, is_left, kind in data:
        if is_left and i != 999:
            win = int(s // 10)
            want[i] = (k, win * 10_000, sum(1 for _, k2, s2, l2, kind2 in data if not l2 and k2 == k and s2 // 10 == win and kind2 == kind))
    assert got == want


def test_counts_go_on_in_another_query(spark, tmp_dir):
    from rivulet.streaming.stateful import exported_counts, keyed_counter

    S.prepare(spark)
    spark.createDataFrame([(i, f"k{i % 3}", i) for i in range(30)], "id long, k string, at long").write.parquet(f"{tmp_dir}/a")
    st = spark.readStream.schema("id long, k string, at long").parquet(f"{tmp_dir}/a")
    S.run_append(keyed_counter(st, "k", "id", "at"), "counts", checkpoint=f"{tmp_dir}/ck")
    state = exported_counts(spark, f"{tmp_dir}/ck", "k")
    assert {(r.k, r.n) for r in state.collect()} == {("k0", 10), ("k1", 10), ("k2", 10)}
    spark.createDataFrame([(100, "k1", 1), (101, "new", 2), (102, "k1", 3)], "id long, k string, at long").write.parquet(f"{tmp_dir}/b")
    st = spark.readStream.schema("id long, k string, at long").parquet(f"{tmp_dir}/b")
    out = S.run_append(keyed_counter(st, "k", "id", "at", state), "counts-2")
    assert {(r.id, r.running) for r in out.collect()} == {(100, 11), (101, 1), (102, 12)}


def test_side_outputs_of_a_replayed_batch(spark, tmp_dir):
    from rivulet.streaming.multi_sink import read_tagged, tag_by, write_tagged

    write = write_tagged(f"{tmp_dir}/out", tag_by({"big": F.col("id") > 5, "odd": F.col("id") % 2 == 1}))
    for batch, rows in ((0, spark.range(8)), (1, spark.range(3)), (0, spark.range(100)), (1, spark.range(50))):
        write(rows, batch)
    schema = spark.range(1).schema

    def got(tag):
        return sorted(r.id for r in read_tagged(spark, f"{tmp_dir}/out", schema, tag).collect())

    assert (got("big"), got("odd"), got("main"), got("none")) == ([6, 7], [1, 1, 3, 5], [0, 0, 2, 2, 4], [])


def _many_keys(spark, monkeypatch, name):
    """Rows of 300 large keys and a null one, and a count of the calls with rows of a processor."""
    import os
    import tempfile

    from rivulet.streaming import stateful

    folder = tempfile.mkdtemp()

    class Counted(getattr(stateful, name)):  # a local class goes to the tasks by value
        def handleInputRows(self, key, rows, timerValues):
            tempfile.mkstemp(dir=folder)
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(stateful, name, Counted)
    S.prepare(spark)
    rng = random.Random(8)
    data = [(i, rng.choice([None, *(2 ** 60 + k for k in range(300))]), rng.randrange(10 ** 6),
             rng.choice([None, float("nan") if i > 2900 else 1.0, -float("inf"), rng.random() - 0.5])) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, k long, us long, v double").withColumn("ts", F.timestamp_micros("us"))
    ordered = defaultdict(list)
    for r in sorted(data, key=lambda r: (r[2] // 1000, r[2], r[0])):
        ordered[r[1]].append(r)
    return df, ordered, lambda: len(os.listdir(folder))


def test_counts_of_many_keys_take_few_calls(spark, monkeypatch):
    from rivulet.streaming.stateful import keyed_counter

    df, ordered, calls = _many_keys(spark, monkeypatch, "KeyedCounter")
    out = S.run_in_time_order(df, "ts", lambda st: keyed_counter(st, "k", "id", "ts", buckets=4), "counts", min_batches=3)
    want = {(r[0], k, n) for k, rows in ordered.items() for n, r in enumerate(rows, 1)}
    assert {tuple(r) for r in out.collect()} == want
    assert 0 < calls() <= 3 * 5


def test_maxima_of_many_keys_take_few_calls(spark, monkeypatch):
    """Null values, and NaN, which is larger than all others."""
    from rivulet.streaming.stateful import keyed_running_max

    df, ordered, calls = _many_keys(spark, monkeypatch, "KeyedRunningMax")
    for kind in ("double", "bigint"):
        rows = df.withColumn("v", F.col("v") if kind == "double" else F.col("id") - 2 ** 60)
        out = S.run_in_time_order(rows, "ts", lambda st: keyed_running_max(st, "k", "id", "ts", "v", buckets=4), "maxima", min_batches=3)
        want = set()
        for k, mine in ordered.items():
            best = None
            for r in mine:
                v = r[3] if kind == "double" else r[0] - 2 ** 60
                if v is not None and (best is None or v > best or v != v):
                    best = v if best is None or best == best else best
                want.add((r[0], k, str(best)))
        assert {(r.id, r.k, str(r.running_max)) for r in out.collect()} == want
    assert 0 < calls() <= 2 * 3 * 5
