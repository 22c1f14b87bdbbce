"""Registered queries run as Structured Streaming jobs over the tables as
file sources (trigger availableNow), read back from their exactly-once sinks
(SURVEY §2.D10, F2, H6, H7, I2, I3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.parse import money
from rivulet.plans.q_basic import _SQL_LINES
from rivulet.plans import q_joins  # noqa: F401 - its oracles are used below
from rivulet.plans.q_report import _SQL_ETL, _SQL_KEY_CITIES
from rivulet.plans.registry import oracles as O
from rivulet.plans.registry import query
from rivulet.streaming import runner as S

_DEC = "DECIMAL(28,2)"


@query("stream_word_count", sql=f"WITH {_SQL_LINES} SELECT word, count(*) AS count FROM words GROUP BY word")
def stream_word_count(t):
    """D10 on a stream: running word counts in update mode; the sink keeps
    the latest count per word."""
    from rivulet.operators import text as TX

    S.prepare(t.spark)
    docs = S.table_stream(t.spark, t.sf_dir, "documents").select("text")
    counts = TX.word_count(TX.document_words(docs))
    return S.run_update(counts, "stream-word-count", ["word"])


def _window_stream(t, delay: str, name: str):
    S.prepare(t.spark)
    ev = S.event_time(S.table_stream(t.spark, t.sf_dir, "events"))
    g = (ev.withWatermark("ts", delay)
         .groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
         .agg(F.sum(money("value")).alias("total"), F.count(F.lit(1)).alias("n")))
    out = g.select(F.col("w.start").cast("timestamp_ntz").alias("win_start"),
                   F.col("w.end").cast("timestamp_ntz").alias("win_end"), "event_type", "total", "n")
    return S.run_append(out, name)


_SQL_CLOSED_WINDOWS = """
SELECT time_bucket(INTERVAL '1 hour', ts) AS win_start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS win_end,
       event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total, count(*) AS n
FROM events GROUP BY 1, 2, 3
HAVING time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '{delay}'"""


@query("stream_event_window", sql=_SQL_CLOSED_WINDOWS.format(delay="0 seconds"))
def stream_event_window(t):
    """H6/L4: event-time tumbling windows with a zero-delay watermark,
    append mode: a window is emitted once the watermark passes its end."""
    return _window_stream(t, "0 seconds", "stream-event-window")


@query("stream_watermark", sql=_SQL_CLOSED_WINDOWS.format(delay="10 minutes"))
def stream_watermark(t):
    """H7: bounded out-of-orderness watermark (10 minutes)."""
    return _window_stream(t, "10 minutes", "stream-watermark")


@query("stream_union", sql="SELECT event_id, event_type FROM events")
def stream_union(t):
    """union of two streams of the same type."""
    S.prepare(t.spark)
    ev = S.table_stream(t.spark, t.sf_dir, "events").select("event_id", "event_type")
    views = ev.where(F.col("event_type") == "view")
    others = ev.where(F.col("event_type").isNull() | (F.col("event_type") != "view"))
    return S.run_append(views.unionByName(others), "stream-union")


@query("stream_keyed_counter", sql="""
SELECT event_id, user_id, count(*) OVER
  (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM events""")
def stream_keyed_counter(t):
    """KeyedProcessFunction with ValueState — transformWithState counter
    emitting `key = n` per record."""
    from rivulet.streaming.stateful import keyed_counter

    S.prepare(t.spark)
    return S.run_in_time_order(t.events.select("event_id", "user_id", "ts"), "ts",
                               lambda ev: keyed_counter(ev, "user_id", "event_id", "ts"), "stream-keyed-counter")


@query("stream_running_max", sql="""
SELECT event_id, user_id, max(value) OVER
  (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running_max FROM events""")
def stream_running_max(t):
    """D12 on a stream: ValueState running max per key, one value per record."""
    from rivulet.streaming.stateful import keyed_running_max

    S.prepare(t.spark)
    return S.run_in_time_order(t.events.select("event_id", "user_id", "ts", "value"), "ts",
                               lambda ev: keyed_running_max(ev, "user_id", "event_id", "ts", "value"),
                               "stream-running-max")


@query("stream_order_timeout", sql="""
WITH v AS (SELECT * FROM events WHERE event_type = 'view'),
m AS (SELECT max(ts) AS wm FROM events WHERE event_type IN ('view', 'purchase')),
s AS (SELECT v.event_id, v.ts, EXISTS (SELECT 1 FROM events p WHERE p.user_id = v.user_id AND p.event_type = 'purchase'
        AND p.ts > v.ts AND p.ts <= v.ts + INTERVAL '6 hours') AS paid FROM v)
SELECT event_id AS order_id, CASE WHEN paid THEN 'paid' ELSE 'cancelled' END AS status
FROM s, m WHERE paid OR s.ts + INTERVAL '6 hours' <= m.wm""")
def stream_order_timeout(t):
    """Order timeout with event-time timers: views are open orders,
    a purchase within 6 hours pays them, the timer cancels the rest. Orders
    whose timer has not fired by the final watermark are still open and not
    emitted."""
    from rivulet.streaming.stateful import order_timeout

    S.prepare(t.spark)

    def build(st):
        ev = S.event_time(st).select("event_id", "user_id", "event_type", "ts", F.unix_micros("ts").alias("ts_us")) \
            .withWatermark("ts", "0 seconds")
        return order_timeout(ev, "user_id", "event_id", "ts_us", "event_type", 6 * 3600, "view", "purchase")

    ev = t.events.where(F.col("event_type").isin("view", "purchase")).select("event_id", "user_id", "event_type", "ts")
    return S.run_in_time_order(ev, "ts", build, "stream-order-timeout")


@query("stream_order_timeout_clock", sql="""
SELECT o_orderkey AS order_id, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')
  THEN 'paid' ELSE 'cancelled' END AS status FROM orders""")
def stream_order_timeout_clock(t):
    """I3 with processing-time timers: orders with a finished line item are
    paid on arrival, the others are cancelled once a second later by the clock. The
    query is stopped when half of the orders have come, and goes on from its
    checkpoint."""
    from rivulet.streaming.clock_timers import PAID, PLACED, run_by_clock, timeout_by_clock

    S.prepare(t.spark)
    placed = t.orders.select(F.col("o_orderkey").alias("order_id"), F.lit(PLACED).alias("kind"))
    paid = t.lineitem.where(F.col("l_linestatus") == "F").select(F.col("l_orderkey").alias("order_id"), F.lit(PAID).alias("kind"))
    half = F.pmod(F.xxhash64("order_id"), F.lit(2)).cast("int")
    rows = placed.unionByName(paid.distinct()).withColumn(S.SLICE, half)
    return S.run_slices(rows, 2, lambda st: timeout_by_clock(st, "order_id", "kind", 1000), "stream-order-clock",
                        run=lambda st, name, checkpoint, path: run_by_clock(st, name, 1000, checkpoint, path))


def _etl_stream(t):
    from rivulet.plans import order_report as R
    from rivulet.plans.q_joins import ip_segments

    S.prepare(t.spark)
    orders = S.table_stream(t.spark, t.sf_dir, "orders")
    return R.etl(R.typed_orders(orders), ip_segments(t))


@query("stream_report_daily", sql=f"""WITH {_SQL_ETL}
SELECT time_bucket(INTERVAL '1 day', order_time, TIMESTAMP '2000-01-01 16:00:00') AS window_start,
       time_bucket(INTERVAL '1 day', order_time, TIMESTAMP '2000-01-01 16:00:00') + INTERVAL '1 day' AS window_end,
       '全国' AS global, CAST(sum(money) AS {_DEC}) AS amount FROM etl GROUP BY 1, 2""")
def stream_report_daily(t):
    """N4/H11 on a stream: national total per UTC+8 day, event time with a
    2-second watermark, update mode (the current window value is emitted
    every trigger), upserted by window into the sink."""
    from rivulet.plans import order_report as R

    etl = _etl_stream(t).withColumn("order_time", F.col("order_time").cast("timestamp")) \
        .withWatermark("order_time", "2 seconds")
    daily = R.daily_totals(etl).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                       F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                                       "global", "amount")
    return S.run_update(daily, "stream-report-daily", ["window_start", "window_end"])


@query("stream_report_levels", sql=f"""WITH {_SQL_ETL}
SELECT 'global' AS level, '全国' AS name, CAST(sum(money) AS {_DEC}) AS amount FROM etl
UNION ALL SELECT 'province', province, CAST(sum(money) AS {_DEC}) FROM etl GROUP BY province
UNION ALL SELECT 'city', city, CAST(sum(money) AS {_DEC}) FROM etl WHERE city IN ({_SQL_KEY_CITIES}) GROUP BY city""")
def stream_report_levels(t):
    """N1–N3 on a stream from one ETL result: running national, province
    and key-city totals in one stateful aggregation, update mode."""
    from rivulet.plans import order_report as R
    from rivulet.plans.q_report import KEY_CITIES

    lv = R.level_rows(_etl_stream(t), KEY_CITIES)
    g = lv.groupBy("level", "name").agg(F.sum("money").alias("amount"))
    return S.run_update(g, "stream-report-levels", ["level", "name"])


@query("stream_dedup_replay", sql="SELECT DISTINCT event_id, event_type FROM events")
def stream_dedup_replay(t):
    """M2 on a stream: the events and a replayed slice of them arrive as two
    streams; duplicates by message id are dropped however late they come, so
    the state keeps every id (RocksDB)."""
    from rivulet.sinks.kafka import dedup_replay

    S.prepare(t.spark)
    ev = S.event_time(S.table_stream(t.spark, t.sf_dir, "events")).select("event_id", "event_type", "ts")
    replay = ev.where(F.col("ts") < F.lit("2024-01-04 00:00:00").cast("timestamp"))
    out = dedup_replay(ev.unionByName(replay), ["event_id"]).select("event_id", "event_type")
    return S.run_append(out, "stream-dedup-replay")


def _views_purchases(t):
    S.prepare(t.spark)
    ev = S.event_time(S.table_stream(t.spark, t.sf_dir, "events")).select("event_id", "user_id", "ts", "event_type")
    ev = ev.withWatermark("ts", "0 seconds")
    v = ev.where(F.col("event_type") == "view").select("user_id", "ts", F.col("event_id").alias("l_id"))
    p = ev.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("r_ts"),
                                                           F.col("event_id").alias("r_id"))
    return v, p


def _window_join_stream(t, slide, name):
    from rivulet.streaming.joins import window_join

    v, p = _views_purchases(t)
    j = window_join(v, p, "user_id", "ts", "r_ts", "1 hour", slide)
    return S.run_append(j.select("user_id", F.col("win.start").cast("timestamp_ntz").alias("win_start"), "l_id", "r_id"),
                        name)


@query("stream_window_join_tumbling", sql=O["window_join_tumbling"])
def stream_window_join_tumbling(t):
    """C7 on a stream: view x purchase of a user in the same 1-hour window."""
    return _window_join_stream(t, None, "stream-join-tumbling")


@query("stream_window_join_sliding", sql=O["window_join_sliding"])
def stream_window_join_sliding(t):
    """C8 on a stream: one pair per shared sliding window."""
    return _window_join_stream(t, "30 minutes", "stream-join-sliding")


_SQL_SESSIONS_OF = """
a AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '30 minutes' THEN 0 ELSE 1 END f FROM {rows}
      WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)),
b AS (SELECT *, sum(f) OVER (PARTITION BY {key} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) s FROM a),
closed AS (SELECT {key} AS k, s, max(ts) + INTERVAL '30 minutes' AS session_end FROM b GROUP BY 1, 2
           HAVING max(ts) + INTERVAL '30 minutes' < (SELECT max(ts) FROM a))"""


@query("stream_window_join_session", sql=f"""
WITH e AS (SELECT * FROM events WHERE event_type IN ('view', 'purchase')), {_SQL_SESSIONS_OF.format(rows="e", key="user_id")}
SELECT l.user_id, l.event_id AS l_id, r.event_id AS r_id FROM b l JOIN b r ON l.user_id = r.user_id AND l.s = r.s
JOIN closed ON closed.k = l.user_id AND closed.s = l.s
WHERE l.event_type = 'view' AND r.event_type = 'purchase'""")
def stream_window_join_session(t):
    """C9 on a stream: pairs of the sessions the watermark has closed."""
    from rivulet.streaming.session_join import session_pairs, session_tags

    S.prepare(t.spark)
    ev = t.events.where(F.col("event_type").isin("view", "purchase")).select(
        "event_id", "user_id", "ts", (F.col("event_type") == "view").alias("is_left"))

    def build(st):
        return session_tags(S.event_time(st).withWatermark("ts", "0 seconds"), "user_id", "ts", "event_id", "is_left", 1800)

    tags = S.run_in_time_order(ev, "ts", build, "stream-join-session", min_batches=2)
    return session_pairs(tags).withColumnRenamed("key", "user_id")


@query("stream_window_cogroup_left", sql="""
WITH j AS (SELECT o_orderkey, time_bucket(INTERVAL '1 day', o_orderdate) AS win_start, l_linenumber
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    AND time_bucket(INTERVAL '1 day', o_orderdate) = time_bucket(INTERVAL '1 day', l_shipdate)),
wm AS (SELECT least((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) AS t)
SELECT j.* FROM j, wm WHERE l_linenumber IS NOT NULL OR win_start + INTERVAL '1 day' <= t""")
def stream_window_cogroup_left(t):
    """C10 on streams: each order with its line items shipped in the same day
    window; an order without any comes when the watermark of both inputs has
    passed its window."""
    from rivulet.streaming.joins import window_join

    S.prepare(t.spark)
    o = S.event_time(S.table_stream(t.spark, t.sf_dir, "orders"), "o_orderdate") \
        .select(F.col("o_orderkey").alias("k"), "o_orderdate").withWatermark("o_orderdate", "0 seconds")
    li = S.event_time(S.table_stream(t.spark, t.sf_dir, "lineitem"), "l_shipdate") \
        .select(F.col("l_orderkey").alias("k"), "l_shipdate", "l_linenumber").withWatermark("l_shipdate", "0 seconds")
    j = window_join(o, li, "k", "o_orderdate", "l_shipdate", "1 day", how="left")
    out = j.select(F.col("k").alias("o_orderkey"), F.col("win.start").cast("timestamp_ntz").alias("win_start"), "l_linenumber")
    return S.run_append(out, "stream-cogroup")


@query("stream_session", sql=f"""WITH {_SQL_SESSIONS_OF.format(rows="events", key="user_id")}
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n
FROM b JOIN closed ON closed.k = user_id AND closed.s = b.s GROUP BY user_id, b.s""")
def stream_session(t):
    """H5 on a stream: closed session windows per user, gap 30 minutes."""
    from rivulet.streaming.joins import sessions

    S.prepare(t.spark)
    ev = S.event_time(S.table_stream(t.spark, t.sf_dir, "events")).select("user_id", "ts").withWatermark("ts", "0 seconds")
    return S.run_append(sessions(ev, ["user_id"], "ts", 1800), "stream-session")


@query("stream_sliding", sql=f"""
WITH e AS (SELECT event_type, value, unnest([time_bucket(INTERVAL '30 minutes', ts),
  time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS win_start FROM events)
SELECT win_start, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS {_DEC}) AS total FROM e GROUP BY 1, 2
HAVING win_start + INTERVAL '1 hour' <= (SELECT max(ts) FROM events)""")
def stream_sliding(t):
    """H2 on a stream: 1-hour windows every 30 minutes, closed ones."""
    S.prepare(t.spark)
    ev = S.event_time(S.table_stream(t.spark, t.sf_dir, "events")).withWatermark("ts", "0 seconds")
    g = ev.groupBy(F.window("ts", "1 hour", "30 minutes").alias("w"), "event_type").agg(F.sum(money("value")).alias("total"))
    return S.run_append(g.select(F.col("w.start").cast("timestamp_ntz").alias("win_start"), "event_type", "total"),
                        "stream-sliding")


@query("stream_dimension", sql="""
SELECT event_id, user_id, c_name FROM events LEFT JOIN customer ON user_id = c_custkey""")
def stream_dimension(t):
    """Events enriched from a file dimension that is read again for every
    micro-batch (null where the dimension has no entry)."""
    from rivulet.session import scratch_path
    from rivulet.streaming.dimension import enrich_each_batch

    S.prepare(t.spark)
    out, ck = scratch_path(t.spark, "dimension-out"), scratch_path(t.spark, "dimension-ck")

    def load():
        return t.customer.select(F.col("c_custkey").cast("bigint").alias("user_id"), "c_name")

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    ev = S.table_stream(t.spark, t.sf_dir, "events").select("event_id", "user_id")
    q = (ev.writeStream.foreachBatch(enrich_each_batch(load, ["user_id"], sink))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "user_id", "c_name")


@query("stream_restart", sql="SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_restart(t):
    """M1: a checkpointed stream is stopped, more files arrive, and it is
    started again: its state goes on from the checkpoint."""
    from rivulet.session import scratch_path

    S.prepare(t.spark)
    source, out, ck = (scratch_path(t.spark, f"restart-{x}") for x in ("in", "out", "ck"))
    e = t.events.select("event_id", "event_type")
    for remainder in (0, 1):
        e.where(F.pmod("event_id", F.lit(2)) == remainder).write.mode("append").parquet(source)
        st = t.spark.readStream.schema(e.schema).parquet(source)
        counts = st.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        result = S.run_update(counts, "restart", ["event_type"], checkpoint=ck, path=out)
    return result


@query("stream_bucketed", sql="SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, count(*) AS n FROM events GROUP BY 1")
def stream_bucketed(t):
    """K8: a streaming file sink with hour buckets of the record time, read back."""
    from rivulet.session import scratch_path
    from rivulet.sinks.files import read_bucketed
    from rivulet.streaming.dimension import stream_bucketed_files

    S.prepare(t.spark)
    path, ck = scratch_path(t.spark, "hours"), scratch_path(t.spark, "hours-ck")
    ev = S.table_stream(t.spark, t.sf_dir, "events").select("event_id", "ts")
    stream_bucketed_files(ev, path, ck, "ts").awaitTermination()
    return read_bucketed(t.spark, path, "bucket").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


# Arrival order as in the batch form (event time plus up to two hours); the
# rows arrive in four slices, so the watermark moves between them.
_SQL_ARRIVED = """
arr AS (SELECT event_id, event_type, epoch_ms(ts) AS ms, CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents,
               epoch_ms(ts) + (event_id * 7919) % 7200 * 1000 AS arrived FROM events),
ends AS (SELECT min(arrived) AS lo, max(arrived) AS hi FROM arr),
r AS (SELECT arr.*, least(3, (arrived - lo) * 4 // greatest(hi - lo, 1)) AS batch, ms - ms % 3600000 AS win FROM arr, ends),
wm AS (SELECT b.batch, (SELECT max(ms) FROM r WHERE r.batch < b.batch) - 1800000 AS wm FROM (SELECT unnest([0, 1, 2, 3, 4]) AS batch) b),
c AS (SELECT r.*, coalesce(win + 3600000 + 1800000 <= wm, false) AS side FROM r JOIN wm USING (batch))"""


@query("stream_allowed_lateness", sql=f"""WITH {_SQL_ARRIVED}
SELECT 'side' AS kind, win AS win_start, event_type AS key, CAST(NULL AS BIGINT) AS total, event_id FROM c WHERE side
UNION ALL SELECT 'total', win, event_type, CAST(sum(cents) AS BIGINT), CAST(NULL AS BIGINT) FROM c WHERE NOT side GROUP BY 2, 3
HAVING win + 3600000 <= (SELECT max(ms) FROM r) - 1800000""")
def stream_allowed_lateness(t):
    """H8/H9 on a stream over several micro-batches: the last total of every
    window that has fired, and the side output of rows later than that."""
    from rivulet.streaming.stateful import allowed_lateness

    S.prepare(t.spark)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    e = t.events.select("event_id", "event_type", "ts", ms.alias("ms"), (money("value") * 100).cast("bigint").alias("cents"),
                        (ms + F.col("event_id") * 7919 % 7200 * 1000).alias("at"))
    lo, hi = e.agg(F.min("at")).scalar(), e.agg(F.max("at")).scalar()
    quarter = F.least(F.lit(3).cast("bigint"), F.floor((F.col("at") - lo) * 4 / F.greatest(hi - lo, F.lit(1))))

    def build(st):
        st = S.event_time(st).withWatermark("ts", "30 minutes").select("event_type", "ms", "cents", "event_id")
        return allowed_lateness(st, "event_type", "ms", "cents", "event_id", 3600, 1800)

    out = S.run_slices(e.withColumn(S.SLICE, quarter).drop("at"), 4, build, "stream-late")
    side = out.where(F.col("kind") == "side")
    # a window's rows only add money or take it in the order of the firings: the last has the most rows
    fired = out.where(F.col("kind") != "side").groupBy("win_start", "key").agg(
        F.max_by("total", F.coalesce("event_id", F.lit(-1))).alias("total"))
    return side.unionByName(fired.select(F.lit("total").alias("kind"), "win_start", "key", "total",
                                         F.lit(None).cast("bigint").alias("event_id")))
