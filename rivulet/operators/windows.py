"""Time windows (tumbling, sliding, offset, session) and count windows on
batch DataFrames. Time windows are Spark's `window()` grouping column;
count windows and sessions use the balanced scan in `scan.py` instead of a
one-task window function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.scan import global_seq


def epoch_us(c) -> Column:
    col = c if isinstance(c, Column) else F.col(c)
    return F.unix_micros(col.cast("timestamp"))


def from_epoch_us(c) -> Column:
    col = c if isinstance(c, Column) else F.col(c)
    return F.timestamp_micros(col).cast("timestamp_ntz")


def time_window(ts: str, size: str, slide: str | None = None, offset: str | None = None) -> Column:
    """Tumbling (slide=None) or sliding window struct(start, end). For a
    sliding window a row appears once per window containing it."""
    if slide is None and offset is None:
        return F.window(ts, size)
    return F.window(ts, size, slide or size, offset or "0 seconds")


def window_line(start: Column, end: Column, key: Column, total: Column,
                fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """`[start~end]-->key=total`, the full-window function's output line."""
    return F.format_string("[%s~%s]-->%s=%s", F.date_format(start, fmt), F.date_format(end, fmt),
                           key.cast("string"), total.cast("string"))


def count_window_tumbling(df: DataFrame, order: Sequence[str], size: int,
                          value: str, total: str = "total") -> DataFrame:
    """Tumbling count window over the whole stream in `order`: windows of
    `size` consecutive rows; an incomplete last window never fires."""
    s = global_seq(df.select(*order, value), order, "_n")
    win = F.floor((F.col("_n") - 1) / size).cast("bigint")
    g = s.groupBy(win.alias("win")).agg(F.sum(value).alias(total), F.count(F.lit(1)).alias("_c"))
    return g.where(F.col("_c") == size).drop("_c")


def count_window_sliding(df: DataFrame, order: Sequence[str], size: int, slide: int,
                         value: str, total: str = "total") -> DataFrame:
    """Sliding count window: fires on every `slide`-th row with the last
    (up to) `size` rows. Each row is added to the at most ceil(size/slide)
    firings that contain it."""
    s = global_seq(df.select(*order, value), order, "_n")
    n_rows = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery: rows in the stream
    first = F.ceil(F.col("_n") / slide).cast("bigint") * slide
    last = F.col("_n") + (size - 1)
    fires = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("bigint")))
    e = s.select(value, F.explode(fires).alias("_f")).where(F.col("_f") <= n_rows)
    return e.groupBy((F.col("_f") / slide).cast("bigint").alias("fire")).agg(F.sum(value).alias(total))


def session_starts(df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap_seconds: int,
                   out: str = "session_start") -> DataFrame:
    """Tag each row with the start time of its session: a new session
    starts when the previous row of the same key is more than `gap` earlier
    (rows exactly one gap apart belong to one session)."""
    from rivulet.operators.scan import session_scan

    d = df.withColumn("_ts_us", epoch_us(ts))
    d = session_scan(d, list(keys), "_ts_us", tie, gap_seconds * 1_000_000, "_sess_us")
    return d.withColumn(out, from_epoch_us("_sess_us")).drop("_ts_us", "_sess_us")


def sessions(df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap_seconds: int) -> DataFrame:
    """Session windows per key: start, end (= last row + gap) and row count."""
    s = session_starts(df.select(*keys, ts, tie), keys, ts, tie, gap_seconds)
    return s.groupBy(*keys, "session_start").agg(
        (F.max(ts) + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        F.count(F.lit(1)).alias("n"))
