"""Registered queries: joins, lookups, window joins, as-of and timer twins
(SURVEY §2.C, I3, J1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import joins as J
from rivulet.operators import window_joins as WJ
from rivulet.plans.registry import query


@query("join_inner", sql="""
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(t):
    """Inner equi-join with a projecting join function."""
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "c_name", "c_mktsegment")


@query("join_left", sql="""
SELECT o_orderkey, l_linenumber, coalesce(l_returnflag, '未知') AS l_returnflag
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def join_left(t):
    """Left outer join, missing side → 未知."""
    o = t.orders.select("o_orderkey")
    li = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    return J.outer_join(o, li, "o_orderkey", "left", fill=["l_returnflag"])


@query("join_right", sql="""
SELECT c_custkey, c_name, o_orderkey, coalesce(o_orderstatus, '未知') AS o_orderstatus
FROM orders RIGHT JOIN customer ON o_custkey = c_custkey""")
def join_right(t):
    """Right outer join (customers without orders get 未知); the name
    comes from the right side."""
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    c = t.customer.select("c_custkey", "c_name")
    return J.outer_join(o, c, "c_custkey", "right", fill=["o_orderstatus"]) \
        .select("c_custkey", "c_name", "o_orderkey", "o_orderstatus")


@query("join_full", sql="""
WITH l AS (SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(18,2)) AS price FROM customer),
r AS (SELECT DISTINCT user_id AS id, 'seen' AS priority FROM events)
SELECT coalesce(r.id, l.id) AS id, l.price, coalesce(r.priority, '未知') AS priority
FROM l FULL OUTER JOIN r ON l.id = r.id""")
def join_full(t):
    """C4: full outer join of the customers and the users of the events; the
    id comes from whichever side exists."""
    from rivulet.functions.parse import money

    left = t.customer.select(F.col("c_custkey").cast("bigint").alias("id"), money("c_acctbal").alias("price"))
    right = t.events.select(F.col("user_id").alias("id")).distinct().withColumn("priority", F.lit("seen"))
    return J.outer_join(left, right, "id", "full", fill=["priority"])


@query("join_broadcast", sql="""
SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def join_broadcast(t):
    """Broadcast-variable lookup (small dimension to every task; a miss
    gives null)."""
    s = t.supplier.select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    n = t.nation.select("n_nationkey", "n_name")
    return J.lookup_join(s, n, "n_nationkey").select("s_suppkey", "s_name", "n_name")


@query("join_cached_file", sql="""
SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def join_cached_file(t):
    """Distributed-cache lookup: the nation table shipped as a CSV file,
    read back as a DataFrame and joined."""
    from rivulet.session import scratch_path

    path = scratch_path(t.spark, "nation-csv")
    t.nation.select("n_nationkey", "n_name").write.csv(path)
    nat = J.read_lookup_file(t.spark, path, "n_nationkey INT, n_name STRING")
    s = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return J.lookup_join(s, nat, "n_nationkey").select("s_suppkey", "n_name")


@query("enrich_lookup", sql="""
SELECT e.event_id, e.user_id, coalesce(c.c_name, '未知') AS c_name
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def enrich_lookup(t):
    """Enrichment of each event from the customer dimension (a miss
    gives 未知)."""
    c = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name")
    e = t.events.select("event_id", "user_id")
    return J.fill_missing(J.lookup_join(e, c, "user_id"), ["c_name"])


# IP ranges: segment k covers [k*171798692, (k+1)*171798692 - 1] and maps to
# nation k (the "city") and its region (the "province"); the last one is
# open to the top of the address space.
_SEG_WIDTH = 171798692
_SQL_SEGMENTS = f"""
seg AS (SELECT CAST(n_nationkey AS BIGINT) * {_SEG_WIDTH} AS seg_start,
               CASE WHEN n_nationkey = (SELECT max(n_nationkey) FROM nation) THEN 4294967295
                    ELSE (CAST(n_nationkey AS BIGINT) + 1) * {_SEG_WIDTH} - 1 END AS seg_end,
               r_name AS province, n_name AS city
        FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def ip_segments(t):
    n, r = t.nation, t.region
    top = n.select(F.max("n_nationkey")).scalar()
    k = F.col("n_nationkey").cast("bigint")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        (k * _SEG_WIDTH).alias("seg_start"),
        F.when(F.col("n_nationkey") == top, F.lit(4294967295)).otherwise((k + 1) * _SEG_WIDTH - 1).alias("seg_end"),
        F.col("r_name").alias("province"), F.col("n_name").alias("city"))


@query("ip_region_lookup", sql=f"""WITH {_SQL_SEGMENTS}
SELECT o_orderkey, ip, province, city FROM
  (SELECT o_orderkey, (o_orderkey * 2654435761) % 4294967296 AS ip FROM orders) p
LEFT JOIN seg ON ip BETWEEN seg_start AND seg_end""")
def ip_region_lookup(t):
    """C11: IP → province/city range lookup as a bucketed equi-join."""
    from rivulet.operators.rangejoin import bucketed_range_join

    pts = t.orders.select("o_orderkey", ((F.col("o_orderkey") * 2654435761) % 4294967296).alias("ip"))
    return bucketed_range_join(pts, ip_segments(t), "ip", bits=18).select("o_orderkey", "ip", "province", "city")


_SQL_VIEW_PURCHASE = """
l AS (SELECT * FROM events WHERE event_type = 'view'), r AS (SELECT * FROM events WHERE event_type = 'purchase')"""


def _views_purchases(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    v = e.where(F.col("event_type") == "view").select("user_id", "ts", F.col("event_id").alias("l_id"))
    p = e.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("r_ts"),
                                                          F.col("event_id").alias("r_id"))
    return v, p


@query("window_join_tumbling", sql=f"""WITH {_SQL_VIEW_PURCHASE}
SELECT l.user_id, time_bucket(INTERVAL '1 hour', l.ts) AS win_start, l.event_id AS l_id, r.event_id AS r_id
FROM l JOIN r ON l.user_id = r.user_id AND time_bucket(INTERVAL '1 hour', l.ts) = time_bucket(INTERVAL '1 hour', r.ts)""")
def window_join_tumbling(t):
    """View × purchase of the same user in the same 1-hour window."""
    v, p = _views_purchases(t)
    return WJ.window_join(v, p, "user_id", "ts", "r_ts", "1 hour").select("user_id", "win_start", "l_id", "r_id")


@query("window_join_sliding", sql="""
WITH e AS (SELECT *, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS win_start FROM events)
SELECT l.user_id, l.win_start, l.event_id AS l_id, r.event_id AS r_id
FROM e l JOIN e r ON l.user_id = r.user_id AND l.win_start = r.win_start
WHERE l.event_type = 'view' AND r.event_type = 'purchase'""")
def window_join_sliding(t):
    """Sliding-window join (1 hour, slide 30 min): one pair per shared
    window."""
    v, p = _views_purchases(t)
    return WJ.window_join(v, p, "user_id", "ts", "r_ts", "1 hour", "30 minutes") \
        .select("user_id", "win_start", "l_id", "r_id")


@query("window_join_session", sql="""
WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '30 minutes' THEN 0 ELSE 1 END f
           FROM events WHERE event_type IN ('view', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) s FROM a)
SELECT l.user_id, l.event_id AS l_id, r.event_id AS r_id FROM b l JOIN b r ON l.user_id = r.user_id AND l.s = r.s
WHERE l.event_type = 'view' AND r.event_type = 'purchase'""")
def window_join_session(t):
    """Session-window join: sessions (gap 30 min) over views and
    purchases together, then view × purchase inside each session."""
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    v = e.where(F.col("event_type") == "view").drop("event_type")
    p = e.where(F.col("event_type") == "purchase").drop("event_type")
    j = WJ.session_window_join(v, p, "user_id", "ts", "event_id", 1800)
    return j.select("user_id", F.col("event_id").alias("l_id"), F.col("event_id_r").alias("r_id"))


@query("window_cogroup_left", sql="""
SELECT o_orderkey, time_bucket(INTERVAL '1 day', o_orderdate) AS win_start, l_linenumber
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
  AND time_bucket(INTERVAL '1 day', o_orderdate) = time_bucket(INTERVAL '1 day', l_shipdate)""")
def window_cogroup_left(t):
    """Window coGroup with left-outer logic: each order with its line
    items shipped in the same day window, or null."""
    o = t.orders.select(F.col("o_orderkey").alias("k"), "o_orderdate")
    li = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_shipdate", "l_linenumber")
    j = WJ.window_cogroup_left(o, li, "k", "o_orderdate", "l_shipdate", "1 day")
    return j.select(F.col("k").alias("o_orderkey"), "win_start", "l_linenumber")


@query("asof_dimension", sql="""
SELECT e.event_id, e.user_id, d.value AS dim_value FROM (SELECT * FROM events WHERE event_type = 'view') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') d ON e.user_id = d.user_id AND e.ts >= d.ts""")
def asof_dimension(t):
    """Broadcast-state lookup as an as-of join: each view sees the
    latest signup value of its user at or before it (null before any)."""
    from rivulet.operators.temporal import asof_join

    e = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    views = e.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    dims = e.where(F.col("event_type") == "signup").select("event_id", "user_id", "ts", "value")
    r = asof_join(views, dims, "user_id", "ts", "event_id", ["value"])
    return r.select("event_id", "user_id", F.col("dim_value"))


@query("order_timeout", sql="""
SELECT v.event_id, CASE WHEN EXISTS (SELECT 1 FROM events p WHERE p.user_id = v.user_id AND p.event_type = 'purchase'
  AND p.ts > v.ts AND p.ts <= v.ts + INTERVAL '6 hours') THEN 'paid' ELSE 'cancelled' END AS status
FROM events v WHERE v.event_type = 'view'""")
def order_timeout(t):
    """I3 (batch twin): an open order (view) not paid (purchase by the same
    user) within 6 hours is cancelled when its timer fires."""
    from rivulet.operators.temporal import next_within

    e = t.events.select("event_id", "user_id", "ts", "event_type")
    views = e.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    buys = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    r = next_within(views, buys, "user_id", "ts", "event_id", 6 * 3600, "paid_at")
    return r.select("event_id", F.when(F.col("paid_at").isNotNull(), "paid").otherwise("cancelled").alias("status"))
