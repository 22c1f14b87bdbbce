"""Window joins and session windows on streams. Both sides carry watermarks;
the state of a (key, window) is dropped once the watermark has passed it. As
in the batch forms, a window join emits every pair of a (key, window)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_join(left: DataFrame, right: DataFrame, key: str, ts_left: str, ts_right: str, size: str,
                slide: str | None = None, how: str = "inner") -> DataFrame:
    """Tumbling (slide=None) or sliding window join of two streams with
    watermarks on their times; the result has the columns of both sides, the key
    once and `win`. With how="left" a left row without a partner comes when
    the watermark passes its window."""
    def windowed(df: DataFrame, ts: str) -> DataFrame:
        w = F.window(ts, size, slide) if slide else F.window(ts, size)
        return df.withColumn("win", w)

    return windowed(left, ts_left).join(windowed(right, ts_right), [key, "win"], how)


def session_gap(ts: str, gap_seconds: int) -> Column:
    """Session window whose rows are at most `gap_seconds` apart; Spark's own
    gap is exclusive, so it is a microsecond longer."""
    return F.session_window(ts, f"{gap_seconds} seconds 1 microsecond")


def sessions(stream: DataFrame, keys: list[str], ts: str, gap_seconds: int) -> DataFrame:
    """Closed session windows per key (of the whole stream without keys):
    session_start, session_end (last row plus the gap) and the row count."""
    g = stream.groupBy(*keys, session_gap(ts, gap_seconds).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    one = F.make_dt_interval(secs=F.lit(0.000001))
    return g.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("session_start"),
                    (F.col("w.end") - one).cast("timestamp_ntz").alias("session_end"), "n")
