"""Event-time lateness on batch data: watermark before each row in arrival
order, classification of rows into on-time / late update / side output,
and the firings of a window with allowed lateness.

Specification (the limit of a watermark advanced after every row):
`wm(n) = max(ts of rows arriving before n) − delay`; with window end `e`,
a row is on time if `wm < e` (or no watermark yet), a late update if
`e <= wm < e + lateness`, else it goes to the side output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.scan import Running, keyed_scan
from rivulet.operators.windows import epoch_us

ON_TIME, LATE_UPDATE, SIDE_OUTPUT = "on_time", "late_update", "side_output"


def classify_late(df: DataFrame, ts: str, arrival: list[str], window_seconds: int,
                  delay_seconds: int, lateness_seconds: int, seq_col: str | None = None) -> DataFrame:
    """Add `wm` (watermark before the row, TIMESTAMP_NTZ), `win_start`,
    `win_end` and `cls`. `arrival` columns give the arrival order (a total
    order); with `seq_col` the 1-based arrival number is added too. The
    running max is a balanced global scan, not a one-task window."""
    d = df.withColumn("_ts_us", epoch_us(ts))
    specs = [Running("_ts_us", "max", "_max_before", inclusive=False)]
    if seq_col:
        specs.append(Running(None, "count", seq_col))
    d = keyed_scan(d, (), arrival, specs)
    win = F.window(ts, f"{window_seconds} seconds")
    d = d.withColumn("win_start", win.start).withColumn("win_end", win.end)
    wm_us = F.col("_max_before") - delay_seconds * 1_000_000
    end_us = epoch_us("win_end")
    cls = (F.when(F.col("_max_before").isNull() | (wm_us < end_us), F.lit(ON_TIME))
            .when(wm_us < end_us + lateness_seconds * 1_000_000, F.lit(LATE_UPDATE))
            .otherwise(F.lit(SIDE_OUTPUT)))
    wm = F.timestamp_micros(wm_us.cast("bigint")).cast("timestamp_ntz")
    return d.withColumn("cls", cls).withColumn("wm", wm).drop("_ts_us", "_max_before")


def allowed_lateness_firings(classified: DataFrame, key: str, value: str, arrival: list[str],
                             seq_col: str) -> DataFrame:
    """Window results with allowed lateness: per (window, key) one firing
    with the on-time total (`fire_n = 0`), then one updated total per late
    row (`fire_n` = that row's arrival number `seq_col`). Side-output rows
    do not change any total."""
    on = classified.where(F.col("cls") == ON_TIME) \
        .groupBy("win_start", key).agg(F.sum(value).alias("_on"))
    late = classified.where(F.col("cls") == LATE_UPDATE).select("win_start", key, value, seq_col)
    late = keyed_scan(late, ["win_start", key], [seq_col], [Running(value, "sum", "_late")])
    first = on.select("win_start", key, F.lit(0).cast("bigint").alias("fire_n"), F.col("_on").alias("total"))
    upd = late.join(on, ["win_start", key], "left").select(
        "win_start", key, F.col(seq_col).cast("bigint").alias("fire_n"),
        (F.coalesce(F.col("_on"), F.lit(0)) + F.col("_late")).cast(dict(on.dtypes)["_on"]).alias("total"))
    return first.unionByName(upd)
