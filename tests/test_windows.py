import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from rivulet.operators import late as L
from rivulet.operators import windows as W

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _ts(sec):
    return T0 + dt.timedelta(seconds=sec)


def test_count_windows(spark):
    df = spark.createDataFrame([(_ts(i), i, i) for i in range(1, 13)], "ts timestamp_ntz, id long, v long")
    tum = W.count_window_tumbling(df, ["ts", "id"], 5, "v")
    assert rows(tum) == [(0, 15), (1, 40)]  # the last 2 rows never fire
    sl = W.count_window_sliding(df, ["ts", "id"], 5, 2, "v")
    # fires at rows 2,4,...,12 over the last <= 5 rows
    exp = [(n // 2, sum(range(max(1, n - 4), n + 1))) for n in range(2, 13, 2)]
    assert rows(sl) == sorted(exp)


def test_sessions_gap_inclusive(spark):
    # 0, 10 (exactly one gap later → same session), 21 (new), other key
    df = spark.createDataFrame([(1, _ts(0), 1), (1, _ts(10), 2), (1, _ts(21), 3), (2, _ts(5), 4)],
                               "k int, ts timestamp_ntz, id long")
    got = rows(W.sessions(df, ["k"], "ts", "id", 10))
    assert got == [(1, _ts(0), _ts(20), 2), (1, _ts(21), _ts(31), 1), (2, _ts(5), _ts(15), 1)]


def test_late_classification(spark):
    # window 10 s, delay 0, lateness 5 s; arrival order = id
    data = [(1, 1), (2, 12), (3, 8), (4, 16), (5, 3), (6, 25), (7, 11)]
    df = spark.createDataFrame([(i, _ts(s)) for i, s in data], "id long, ts timestamp_ntz")
    got = {r["id"]: r["cls"] for r in L.classify_late(df, "ts", ["id"], 10, 0, 5).collect()}
    # wm before 3 is 12 → window [0,10) closed, 12 < 15 → late update
    # wm before 5 is 16 → 16 >= 15 → side output; 7: wm 25, window [10,20) end 20, 25 >= 25 → side
    assert got == {1: "on_time", 2: "on_time", 3: "late_update", 4: "on_time", 5: "side_output",
                   6: "on_time", 7: "side_output"}


def test_daily_window_offset(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 15, 59),), (dt.datetime(2024, 1, 1, 16, 0),)],
                               "ts timestamp_ntz")
    got = rows(df.select(W.time_window("ts", "1 day", "1 day", "-8 hours").start.alias("s")))
    assert got == [(dt.datetime(2023, 12, 31, 16, 0),), (dt.datetime(2024, 1, 1, 16, 0),)]


def test_window_line_format(spark):
    df = spark.createDataFrame([(T0, dt.datetime(2024, 1, 1, 0, 0, 5), "gate1", 7)],
                               "s timestamp_ntz, e timestamp_ntz, k string, n long")
    line = df.select(W.window_line(F.col("s"), F.col("e"), F.col("k"), F.col("n"))).first()[0]
    assert line == "[2024-01-01 00:00:00~2024-01-01 00:00:05]-->gate1=7"


def test_window_cogroup_user_logic(spark):
    """C10 general form: coGroup per (key, window) with arbitrary code —
    left rows joined to right rows of the same window, null when none."""
    import pandas as pd

    from rivulet.operators.window_joins import cogroup_apply, window_cogroup_left

    main = spark.createDataFrame([(_ts(1), "o1", "main"), (_ts(2), "o2", "main"), (_ts(12), "o3", "main")],
                                 "ts timestamp_ntz, order_id string, type string")
    detail = spark.createDataFrame([(_ts(3), "o1", "detail", "d1"), (_ts(4), "o1", "detail", "d2"),
                                    (_ts(13), "o2", "detail", "d3")],
                                   "ts timestamp_ntz, order_id string, type string, detail_id string")
    m = main.withColumn("win", W.time_window("ts", "5 seconds").start)
    d = detail.withColumn("win", W.time_window("ts", "5 seconds").start)

    def left_outer(l, r):
        if len(l) == 0:
            return pd.DataFrame({"order_id": pd.Series([], dtype=object), "detail_id": pd.Series([], dtype=object)})
        ids = list(r["detail_id"]) or [None]
        return pd.DataFrame([(o, x) for o in l["order_id"] for x in ids], columns=["order_id", "detail_id"])

    got = rows(cogroup_apply(m, d, ["order_id", "win"], left_outer, "order_id string, detail_id string"))
    assert got == [("o1", "d1"), ("o1", "d2"), ("o2", None), ("o3", None)]
    via_join = rows(window_cogroup_left(main.drop("type"), detail.drop("type").withColumnRenamed("ts", "ts_r"),
                                        "order_id", "ts", "ts_r", "5 seconds"), "order_id", "detail_id")
    assert via_join == got


def test_asof_replaces_the_whole_entry(spark):
    """The newest row (name null, age 30) replaces (bob, 20): not (bob, 30)."""
    from rivulet.operators.temporal import asof_join

    facts = spark.createDataFrame([(1, _ts(10), 100), (2, _ts(10), 101), (1, _ts(0), 102)], "k int, ts timestamp_ntz, id long")
    dims = spark.createDataFrame([(1, _ts(1), 1, "bob", 20), (1, _ts(5), 2, None, 30)],
                                 "k int, ts timestamp_ntz, id long, name string, age int")
    got = asof_join(facts, dims, "k", "ts", "id", ["name", "age"])
    assert {r["id"]: (r["dim_name"], r["dim_age"]) for r in got.collect()} == {100: (None, 30), 101: (None, None), 102: (None, None)}


def test_sliding_count_windows_with_gaps(spark):
    df = spark.createDataFrame([(_ts(i), i, i) for i in range(1, 13)], "ts timestamp_ntz, id long, v long")
    got = W.count_window_sliding(df, ["ts", "id"], 2, 5, "v")  # some rows are in no window
    assert rows(got) == [(1, 9), (2, 19)]


def test_unknown_province_keeps_its_null_name(spark):
    from rivulet.plans.order_report import all_levels

    e = spark.createDataFrame([("P", "C", 1), (None, None, 2)], "province string, city string, money int")
    got = {(r.level, r.name): r.amount for r in all_levels(e, ["C"]).collect()}
    assert got == {("global", "全国"): 3, ("province", "P"): 1, ("province", None): 2, ("city", "C"): 1}
