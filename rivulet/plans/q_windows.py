"""Registered queries: time windows, count windows, sessions, lateness
(SURVEY §2.H, D14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.parse import money
from rivulet.operators import windows as W
from rivulet.plans.registry import query

_DEC = "DECIMAL(28,2)"


@query("win_tumbling", sql=f"""
SELECT time_bucket(INTERVAL '1 hour', ts) AS win_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS win_end,
       event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS {_DEC}) AS total, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
def win_tumbling(t):
    """H1: 1-hour tumbling window, keyed sum."""
    e = t.events
    w = W.time_window("ts", "1 hour")
    return e.groupBy(w.alias("w"), "event_type").agg(
        F.sum(money("value")).alias("total"), F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("win_start"), F.col("w.end").alias("win_end"), "event_type", "total", "n")


@query("win_sliding", sql=f"""
WITH e AS (SELECT *, unnest([time_bucket(INTERVAL '1 hour', ts), time_bucket(INTERVAL '1 hour', ts) - INTERVAL '1 hour']) AS win_start FROM events)
SELECT win_start, win_start + INTERVAL '2 hours' AS win_end, event_type,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS {_DEC}) AS total, count(*) AS n
FROM e GROUP BY 1, 2, 3""")
def win_sliding(t):
    """H2: 2-hour window sliding by 1 hour, keyed sum."""
    e = t.events
    w = W.time_window("ts", "2 hours", "1 hour")
    return e.groupBy(w.alias("w"), "event_type").agg(
        F.sum(money("value")).alias("total"), F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("win_start"), F.col("w.end").alias("win_end"), "event_type", "total", "n")


@query("win_daily_offset", sql="""
SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '2000-01-01 16:00:00') AS win_start, count(*) AS n
FROM events GROUP BY 1""")
def win_daily_offset(t):
    """Daily windows of UTC+8 (1 day, offset -8 h)."""
    w = W.time_window("ts", "1 day", "1 day", "-8 hours")
    return t.events.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("win_start"), "n")


@query("sql_tumble", sql=f"""
SELECT user_id, time_bucket(INTERVAL '1 hour', ts) AS win_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS win_end,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS {_DEC}) AS amount
FROM events GROUP BY 1, 2, 3""")
def sql_tumble(t):
    """Tumbling window written in SQL over a temp view."""
    spark = t.spark
    return spark.sql(
        """SELECT user_id, window.start AS win_start, window.end AS win_end,
                  sum(CAST(value AS DECIMAL(18,2))) AS amount
           FROM {ev} GROUP BY user_id, window(ts, '1 hour')""", ev=t.events)


@query("window_apply_format", sql=f"""
SELECT time_bucket(INTERVAL '1 hour', ts) AS win_start, event_type,
  '[' || strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') || '~'
      || strftime(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') || ']-->'
      || event_type || '=' || CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS {_DEC}) AS VARCHAR) AS line
FROM events GROUP BY 1, 2""")
def window_apply_format(t):
    """Full-window function `[start~end]-->key=total`."""
    w = W.time_window("ts", "1 hour")
    g = t.events.groupBy(w.alias("w"), "event_type").agg(F.sum(money("value")).alias("total"))
    return g.select(F.col("w.start").alias("win_start"), "event_type",
                    W.window_line(F.col("w.start"), F.col("w.end"), F.col("event_type"), F.col("total")).alias("line"))


@query("win_count_tumbling", sql=f"""
WITH s AS (SELECT row_number() OVER (ORDER BY ts, event_id) n, value FROM events)
SELECT CAST((n - 1) // 5 AS BIGINT) AS win, CAST(sum(CAST(value AS DECIMAL(18,2))) AS {_DEC}) AS total
FROM s GROUP BY 1 HAVING count(*) = 5""")
def win_count_tumbling(t):
    """H3: tumbling count window of 5 rows over the stream in (ts, id)
    order; the incomplete tail does not fire."""
    e = t.events.select("ts", "event_id", money("value").alias("v"))
    return W.count_window_tumbling(e, ["ts", "event_id"], 5, "v")


@query("win_count_sliding", sql=f"""
WITH s AS (SELECT row_number() OVER (ORDER BY ts, event_id) n, CAST(value AS DECIMAL(18,2)) v FROM events),
w AS (SELECT n, sum(v) OVER (ORDER BY n ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) t FROM s)
SELECT CAST(n // 2 AS BIGINT) AS fire, CAST(t AS {_DEC}) AS total FROM w WHERE n % 2 = 0""")
def win_count_sliding(t):
    """H4: count window of 5 sliding by 2."""
    e = t.events.select("ts", "event_id", money("value").alias("v"))
    return W.count_window_sliding(e, ["ts", "event_id"], 5, 2, "v")


_SQL_SESSIONS = """
a AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '30 minutes' THEN 0 ELSE 1 END f FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) s FROM a)"""


@query("win_session", sql=f"""WITH {_SQL_SESSIONS}
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n
FROM b GROUP BY user_id, s""")
def win_session(t):
    """H5: session windows per user, gap 30 minutes."""
    return W.sessions(t.events.select("user_id", "ts", "event_id"), ["user_id"], "ts", "event_id", 1800)


# Late data: arrival order = event time plus a deterministic delay of up to
# two hours; watermark delay 30 min, 1-hour windows, lateness 30 min.
_SQL_LATE = """
arr AS (SELECT *, row_number() OVER (ORDER BY ts + to_seconds((event_id * 7919) % 7200), event_id) AS n FROM events),
w AS (SELECT *, max(ts) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '30 minutes' AS wm,
             time_bucket(INTERVAL '1 hour', ts) AS win_start,
             time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS win_end FROM arr),
c AS (SELECT *, CASE WHEN wm IS NULL OR wm < win_end THEN 'on_time'
                     WHEN wm < win_end + INTERVAL '30 minutes' THEN 'late_update' ELSE 'side_output' END AS cls FROM w)"""


def _classified(t):
    from rivulet.operators.late import classify_late

    e = t.events.select("event_id", "ts", "event_type", money("value").alias("v"))
    e = e.withColumn("arrival_us", W.epoch_us("ts") + (F.col("event_id") * 7919 % 7200) * 1_000_000)
    return classify_late(e, "ts", ["arrival_us", "event_id"], 3600, 1800, 1800, seq_col="n")


def _classified_once(t):
    from rivulet.session import written

    return written(_classified(t), "classified")  # read by several scans


@query("late_classify", sql=f"WITH {_SQL_LATE} SELECT event_id, n, wm, cls FROM c")
def late_classify(t):
    """H8/H9 spec: watermark before each row in arrival order and the row's
    class (on time / late update / side output)."""
    return _classified(t).select("event_id", "n", "wm", "cls")


@query("win_allowed_lateness", sql=f"""WITH {_SQL_LATE},
ont AS (SELECT win_start, event_type, sum(CAST(value AS DECIMAL(18,2))) AS s FROM c WHERE cls = 'on_time' GROUP BY 1, 2),
late AS (SELECT win_start, event_type, n, sum(CAST(value AS DECIMAL(18,2))) OVER
           (PARTITION BY win_start, event_type ORDER BY n ROWS UNBOUNDED PRECEDING) AS rs FROM c WHERE cls = 'late_update')
SELECT win_start, event_type, CAST(0 AS BIGINT) AS fire_n, CAST(s AS {_DEC}) AS total FROM ont
UNION ALL
SELECT l.win_start, l.event_type, CAST(l.n AS BIGINT), CAST(coalesce(o.s, 0) + l.rs AS {_DEC})
FROM late l LEFT JOIN ont o USING (win_start, event_type)""")
def win_allowed_lateness(t):
    """H8: 1-hour windows per event type fire at the watermark with the
    on-time total, then once more per late row until end + 30 min."""
    from rivulet.operators.late import allowed_lateness_firings

    return allowed_lateness_firings(_classified_once(t), "event_type", "v", ["n"], "n")


@query("late_side_output", sql=f"WITH {_SQL_LATE} SELECT event_id, ts, event_type FROM c WHERE cls = 'side_output'")
def late_side_output(t):
    """H9: rows later than the allowed lateness, as a side output."""
    return _classified(t).where(F.col("cls") == "side_output").select("event_id", "ts", "event_type")


@query("win_session_global", sql="""
WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '2 minutes' THEN 0 ELSE 1 END f FROM events
           WINDOW w AS (ORDER BY ts, event_id)),
b AS (SELECT *, sum(f) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) s FROM a)
SELECT min(ts) AS session_start, max(ts) + INTERVAL '2 minutes' AS session_end, count(*) AS n FROM b GROUP BY s""")
def win_session_global(t):
    """H5 without a key: sessions of the whole stream, gap 2 minutes."""
    return W.sessions(t.events.select("ts", "event_id"), [], "ts", "event_id", 120)
