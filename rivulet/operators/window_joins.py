"""Window joins: pairs of rows with the same key in the same tumbling,
sliding or session window, and the window co-group (left outer within a
window). A window join's output is by definition every pair in a
(key, window); it is planned as an equi-join on (key, window start), so
Spark shuffles both sides on that pair and AQE splits skewed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.windows import session_starts, time_window
from rivulet.session import written


def _with_window(df: DataFrame, ts: str, size: str, slide: str | None) -> DataFrame:
    # a sliding window expands a row into one row per window containing it
    return df.withColumn("win_start", time_window(ts, size, slide).start)


def window_join(left: DataFrame, right: DataFrame, key: str, ts_left: str, ts_right: str,
                size: str, slide: str | None = None, how: str = "inner") -> DataFrame:
    """Tumbling (slide=None) or sliding window join; a pair sharing several
    sliding windows is emitted once per shared window."""
    lw = _with_window(left, ts_left, size, slide)
    rw = _with_window(right, ts_right, size, slide)
    return lw.join(rw, [key, "win_start"], how)


def window_cogroup_left(left: DataFrame, right: DataFrame, key: str, ts_left: str,
                        ts_right: str, size: str) -> DataFrame:
    """coGroup within a window with left-outer logic: every left row, with
    each right row of the same key and window, or nulls when there is none."""
    return window_join(left, right, key, ts_left, ts_right, size, how="left")


def cogroup_apply(left: DataFrame, right: DataFrame, keys: Sequence[str], fn, schema: str) -> DataFrame:
    """General coGroup with arbitrary Python logic over both groups (both
    groups of a key go to one task, so the keys must include the window and
    windows must be small)."""
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(fn, schema)


def session_window_join(left: DataFrame, right: DataFrame, key: str, ts: str, tie: str,
                        gap_seconds: int) -> DataFrame:
    """Session-window join: sessions (gap `gap_seconds`, per key) are built
    from both inputs together, then each left row is paired with each
    right row of the same session. Inputs share the columns key, ts, tie;
    output columns of the right side are suffixed `_r`."""
    tag = "_side"
    lt = left.withColumn(tag, F.lit("l"))
    rt = right.select(*left.columns).withColumn(tag, F.lit("r"))
    # both sides of the join read the sessions, so they are written once
    s = written(session_starts(lt.unionByName(rt), [key], ts, tie, gap_seconds), "sessions")
    ls = s.where(F.col(tag) == "l").drop(tag)
    rs = s.where(F.col(tag) == "r").drop(tag)
    rs = rs.select(*[F.col(c).alias(c if c in (key, "session_start") else f"{c}_r") for c in rs.columns])
    return ls.join(rs, [key, "session_start"])
