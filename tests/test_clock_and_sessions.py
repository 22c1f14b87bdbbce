import datetime as dt
import json
import os
import time
from pyspark.sql import functions as F
from conftest import SF_SMALL, rows
from rivulet.streaming import runner as S
from rivulet.streaming.clock_timers import run_by_clock, timeout_by_clock
from rivulet.streaming.session_join import session_pairs, session_tags
from tools.oracle_check import check


def test_queries_match_their_oracles(spark):
    keys = ["stream_window_join_session", "stream_order_timeout_clock"]
    assert set(check(spark, SF_SMALL, keys, verbose=False).values()) == {"ok"}


def test_sessions_of_a_hot_key_over_many_batches(spark):
    """One session over all micro-batches, one that a later row ends, one that
    is still open, rows without key or time."""
    at = dt.datetime(2024, 1, 1)
    data = [(i, 7, at + dt.timedelta(seconds=i), i % 3 == 0) for i in range(600)]
    data += [(1000 + i, 7, at + dt.timedelta(seconds=2000 + i), i < 2) for i in range(4)]
    data += [(2000, 8, at + dt.timedelta(seconds=10), True), (2001, 8, at + dt.timedelta(seconds=20), False),
             (3000, 9, at + dt.timedelta(seconds=2002), True), (3001, 9, at + dt.timedelta(seconds=2003), False),
             (4000, None, at, True), (4001, None, at, False), (4002, 8, None, True)]
    ev = spark.createDataFrame(data, "id long, user long, ts timestamp_ntz, is_left boolean").repartition(3)
    spark.conf.set(S.ROWS_PER_BATCH, "100")
    try:
        S.prepare(spark)
        tags = S.run_in_time_order(
            ev, "ts", lambda st: session_tags(S.event_time(st).withWatermark("ts", "0 seconds"), "user", "ts", "id", "is_left", 60),
            "tags")
        got = rows(session_pairs(tags))
    finally:
        spark.conf.unset(S.ROWS_PER_BATCH)
    long = [r for r in data if r[0] < 600]
    assert got == sorted([(7, a[0], b[0]) for a in long if a[3] for b in long if not b[3]] + [(8, 2000, 2001)])
    assert tags.where("is_left IS NULL").count() == 2


def _put(path, name, orders):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/.{name}", "w") as f:
        f.writelines(json.dumps({"id": i, "kind": k}) + "\n" for i, k in orders)
    os.rename(f"{path}/.{name}", f"{path}/{name}")


def test_unpaid_orders_are_cancelled_once_by_a_clock(spark, tmp_dir):
    src, ck, out, hand = (f"{tmp_dir}/{x}" for x in ("in", "ck", "out", "clock"))

    def set_clock(ms):
        with open(hand + ".new", "w") as f:
            f.write(str(ms))
        os.rename(hand + ".new", hand)

    def clock():
        with open(hand) as f:
            return int(f.read())

    def run():
        st = spark.readStream.schema("id long, kind string").json(src)
        return rows(run_by_clock(timeout_by_clock(st, "id", "kind", 5000, buckets=2, clock=clock), "clock", 500, ck, out,
                                 limit_s=120))

    S.prepare(spark)
    set_clock(0)
    _put(src, "a.json", [(1, "placed"), (2, "placed"), (3, "placed"), (4, "paid"), (None, "placed"), (2, "placed")])
    assert run() == []
    set_clock(4999)  # not due yet, over a restart; 4 was paid before it came
    _put(src, "b.json", [(1, "paid"), (4, "placed"), (5, "placed")])
    assert run() == [(1, "paid"), (4, "paid")]
    set_clock(5000)  # 2 and 3 are due, 5 is not; timers need a first input after a restart
    _put(src, "c.json", [(7, "paid")])
    assert run() == [(1, "paid"), (2, "cancelled"), (3, "cancelled"), (4, "paid")]
    _put(src, "d.json", [(3, "paid")])  # too late
    set_clock(9999)
    expected = [(1, "paid"), (2, "cancelled"), (3, "cancelled"), (4, "paid"), (5, "cancelled")]
    assert run() == expected
    assert run() == expected


def test_orders_by_the_clock_of_the_job(spark, tmp_dir):
    S.prepare(spark)
    _put(f"{tmp_dir}/in", "a.json", [(i, "placed") for i in range(50)] + [(i, "paid") for i in range(0, 50, 2)])
    st = spark.readStream.schema("id long, kind string").json(f"{tmp_dir}/in")
    began = time.monotonic()
    got = rows(run_by_clock(timeout_by_clock(st, "id", "kind", 800), "job-clock", 800, f"{tmp_dir}/ck", limit_s=120))
    assert got == [(i, "cancelled" if i % 2 else "paid") for i in range(50)]
    assert time.monotonic() - began > 0.8


def test_no_orders(spark, tmp_dir):
    S.prepare(spark)
    os.makedirs(f"{tmp_dir}/in")
    st = spark.readStream.schema("id long, kind string").json(f"{tmp_dir}/in")
    assert rows(run_by_clock(timeout_by_clock(st, "id", "kind", 100), "none", 100, f"{tmp_dir}/ck", limit_s=60)) == []


def _calls(monkeypatch, module, name):
    """Counts in files the calls with rows of a module's processor in its tasks."""
    import tempfile

    folder = tempfile.mkdtemp()

    class Counted(getattr(module, name)):  # a local class goes to the tasks by value
        def handleInputRows(self, key, rows, timerValues):
            tempfile.mkstemp(dir=folder)
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(module, name, Counted)
    return lambda: len(os.listdir(folder))


def test_sessions_of_many_keys_take_few_calls(spark, monkeypatch):
    import random

    from rivulet.streaming import session_join

    calls, at, rng = _calls(monkeypatch, session_join, "SessionTags"), dt.datetime(2024, 1, 1), random.Random(3)
    data = [(i, f"k{rng.randrange(400)}", at + dt.timedelta(milliseconds=rng.randrange(3_000_000)), rng.random() < 0.5) for i in range(4000)]
    data += [(9000 + i, "last", at + dt.timedelta(seconds=3050 + i), True) for i in range(2)]
    ev = spark.createDataFrame(data, "id long, user string, ts timestamp_ntz, is_left boolean").repartition(3)
    S.prepare(spark)
    tags = S.run_in_time_order(ev, "ts", lambda st: session_tags(
        S.event_time(st).withWatermark("ts", "0 seconds"), "user", "ts", "id", "is_left", 200, buckets=4), "many", min_batches=4)
    want, ended, now = {}, set(), max(r[2] for r in data)
    for k in {r[1] for r in data}:
        mine, last = sorted((r for r in data if r[1] == k), key=lambda r: r[2]), None
        for r in mine:
            if last is None or r[2] - last > dt.timedelta(seconds=200):
                if last is not None:
                    ended.add((k, first))
                first = r[2]
            want[r[0]], last = (k, first), r[2]
        if now - last > dt.timedelta(seconds=200):
            ended.add((k, first))
    got = [(r.id, r.key, at + dt.timedelta(microseconds=r.session - 1_704_067_200_000_000)) for r in tags.collect()]
    assert {i: (k, s) for i, k, s in got if i is not None} == want
    assert sorted((k, s) for i, k, s in got if i is None) == sorted(ended)
    assert 0 < calls() <= 4 * 4


def test_order_timeouts_of_many_users_take_few_calls(spark, monkeypatch):
    """Also users of large ids beside null ones, whose orders nothing pays."""
    import random

    from rivulet.streaming import stateful

    calls, at, rng, big = _calls(monkeypatch, stateful, "OrderTimeout"), dt.datetime(2024, 1, 1), random.Random(4), 2 ** 60
    data = [(i, rng.choice([None, *(big + k for k in range(300))]), at + dt.timedelta(milliseconds=rng.randrange(3_000_000)),
             rng.choice(["view", "purchase"])) for i in range(4000)]
    data += [(9000, 1, at + dt.timedelta(seconds=3100), "purchase"), (9001, 2, None, "view")]
    ev = spark.createDataFrame(data, "id long, user long, ts timestamp_ntz, kind string").repartition(3)
    S.prepare(spark)
    out = S.run_in_time_order(ev, "ts", lambda st: stateful.order_timeout(
        S.event_time(st).withColumn("us", F.unix_micros("ts")).withWatermark("ts", "0 seconds"),
        "user", "id", "us", "kind", 300, "view", "purchase", buckets=4), "timeouts", min_batches=4)
    want = []
    for i, user, ts, kind in data:
        if kind == "view" and ts:
            until = ts + dt.timedelta(seconds=300)
            if any(u is not None and u == user and k == "purchase" and ts < t <= until for _, u, t, k in data if t):
                want.append((i, "paid"))
            elif until <= at + dt.timedelta(seconds=3100):
                want.append((i, "cancelled"))
    assert rows(out) == sorted(want)
    assert 0 < calls() <= 4 * 5
