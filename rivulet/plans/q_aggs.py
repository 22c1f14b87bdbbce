"""Registered queries: aggregations, running aggregates, sorting, set
operations and Table-API/SQL forms (SURVEY §2.D, E, F, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.parse import money
from rivulet.operators import agg as A
from rivulet.operators.scan import Running, global_seq, keyed_scan
from rivulet.plans.q_basic import _SQL_LINES
from rivulet.plans.registry import query

_DEC = "DECIMAL(28,2)"
_TYPE_COUNTS = "c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)"


def _type_counts(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("agg_min", sql=f"WITH {_TYPE_COUNTS} SELECT min(n) AS min_n FROM c")
def agg_min(t):
    """Global min of one field (only that column is defined)."""
    return _type_counts(t).agg(F.min("n").alias("min_n"))


@query("agg_min_by", sql="""
SELECT p_brand, p_retailprice, p_partkey, p_name FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS rn FROM part)
WHERE rn = 1""")
def agg_min_by(t):
    """D3: minBy — per brand the whole part row with the lowest price,
    ties to the smallest key."""
    return A.min_by_row(t.part, ["p_brand"], "p_retailprice", ["p_partkey"], ["p_name"])


@query("agg_sum_max", sql=f"WITH {_TYPE_COUNTS} SELECT CAST(sum(n) AS BIGINT) AS sum_n, max(n) AS max_n FROM c")
def agg_sum_max(t):
    """aggregate(SUM) and aggregate(MAX) over the per-type counts."""
    return _type_counts(t).agg(F.sum("n").alias("sum_n"), F.max("n").alias("max_n"))


@query("reduce_pairs", sql="SELECT event_type, count(*) AS total FROM events GROUP BY 1")
def reduce_pairs(t):
    """groupBy(type).reduce((a, b) -> a + b), the built-in sum."""
    ones = t.events.select("event_type", F.lit(1).cast("bigint").alias("one"))
    return ones.groupBy("event_type").agg(F.sum("one").alias("total"))


@query("reduce_gcd", sql="""
SELECT o_orderpriority, list_reduce(list(o_custkey * 6), lambda a, b: gcd(a, b)) AS g FROM orders GROUP BY 1""")
def reduce_gcd(t):
    """Reduce with a function Spark has no aggregate for (the greatest
    common divisor), partial per partition then merged per key."""
    import numpy as np

    o = t.orders.select("o_orderpriority", (F.col("o_custkey").cast("bigint") * 6).alias("v"))
    return A.reduce_pairs(o, ["o_orderpriority"], "v", np.gcd, "g", "bigint")


@query("reduce_group", sql="SELECT event_type, '(' || event_type || ', ' || count(*) || ')' AS line FROM events GROUP BY 1")
def reduce_group(t):
    """reduceGroup emitting `(key, sum)` strings, as a built-in
    aggregate + format."""
    g = _type_counts(t)
    return g.select("event_type", F.format_string("(%s, %d)", "event_type", "n").alias("line"))


@query("agg_count", sql="SELECT count(*) AS n FROM events")
def agg_count(t):
    """count()."""
    return t.events.agg(F.count(F.lit(1)).alias("n"))


@query("distinct_field", sql="""
SELECT event_type, min(event_id) AS event_id,
       arg_min(user_id, event_id) AS user_id FROM events GROUP BY 1""")
def distinct_field(t):
    """distinct("field") keeping one deterministic row per value (the
    smallest id)."""
    return A.min_by_row(t.events, ["event_type"], "event_id", [], ["user_id"])


@query("distinct_rows", sql="SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(t):
    """distinct() over whole rows."""
    return t.events.select("user_id", "event_type").distinct()


@query("running_sum", sql=f"""
SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER
  (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS {_DEC}) AS running_total FROM events""")
def running_sum(t):
    """Per-key running sum, one updated total per record."""
    e = t.events.select("event_id", "user_id", "ts", money("value").alias("v"))
    r = keyed_scan(e, ["user_id"], ["ts", "event_id"], [Running("v", "sum", "running_total")])
    return r.select("event_id", "user_id", F.col("running_total").cast("decimal(28,2)").alias("running_total"))


@query("running_max", sql="""
SELECT event_id, user_id, max(value) OVER
  (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running_max FROM events""")
def running_max(t):
    """Per-key running max (the ValueState max demo)."""
    e = t.events.select("event_id", "user_id", "ts", "value")
    r = keyed_scan(e, ["user_id"], ["ts", "event_id"], [Running("value", "max", "running_max")])
    return r.select("event_id", "user_id", "running_max")


@query("keyed_counter", sql="""
SELECT event_id, user_id, count(*) OVER
  (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM events""")
def keyed_counter(t):
    """I2 (batch twin): per-key counter emitting `key = n` per record."""
    e = t.events.select("event_id", "user_id", "ts")
    r = keyed_scan(e, ["user_id"], ["ts", "event_id"], [Running(None, "count", "running")])
    return r.select("event_id", "user_id", "running")


@query("udaf_decimal_sum", sql=f"""
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS {_DEC}) AS sum_price
FROM lineitem GROUP BY 1, 2""")
def udaf_decimal_sum(t):
    """A user-defined incremental aggregate (create/add/merge/result),
    evaluated partial-per-partition then merged."""
    cents = (money("l_extendedprice") * 100).cast("bigint").alias("cents")
    li = t.lineitem.select("l_returnflag", "l_linestatus", cents)
    return A.incremental_aggregate(li, ["l_returnflag", "l_linestatus"], A.UnscaledSum("cents"),
                                   ["cents"], "sum_price", "decimal(28,2)")


@query("observed_count", sql="SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS seen FROM events GROUP BY 1")
def observed_count(t):
    """Accumulator counting the rows that flow through a job; read
    after its action and returned with the job's result."""
    from rivulet.session import written

    df, obs = A.observe_count(t.events.select("event_id", "event_type"), "events_seen")
    out = written(df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "observed")
    return out.withColumn("seen", F.lit(obs.get["rows"]).cast("bigint"))


def _word_counts(t):
    from rivulet.operators import text as TX

    return TX.word_count(TX.document_words(t.documents.select("text")))


@query("sort_global", sql=f"""WITH {_SQL_LINES}, wc AS (SELECT word, count(*) AS count FROM words GROUP BY word)
SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS rank FROM wc""")
def sort_global(t):
    """Global sort of word counts (descending, ties by word) with the
    rank as a column — a range-partitioned scan, not one task."""
    from rivulet.session import written

    # written: the scan reads its input several times
    wc = written(_word_counts(t).withColumn("_neg", -F.col("count")), "word-counts")
    return global_seq(wc, ["_neg", "word"], "rank").select("word", "count", "rank")


@query("union_bag", sql="""
SELECT event_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10'""")
def union_bag(t):
    """bag union of two overlapping slices (duplicates kept)."""
    e = t.events.select("event_id", "event_type", "ts")
    a = e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).drop("ts")
    b = e.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).drop("ts")
    return a.unionByName(b)


@query("connect_comap", sql="""
SELECT 'event' AS source, event_id AS id, CAST(value AS DECIMAL(18,2)) AS amount FROM events
UNION ALL SELECT 'order', o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) FROM orders""")
def connect_comap(t):
    """connect two differently typed inputs, one map per side into a
    common shape, then union."""
    ev = t.events.select(F.lit("event").alias("source"), F.col("event_id").alias("id"),
                         money("value").alias("amount"))
    od = t.orders.select(F.lit("order").alias("source"), F.col("o_orderkey").alias("id"),
                         money("o_totalprice").alias("amount"))
    return ev.unionByName(od)


@query("sql_union_all", sql="""
SELECT o_custkey AS "user", o_orderpriority AS product, o_totalprice AS amount FROM orders WHERE o_totalprice > 400000
UNION ALL
SELECT l_suppkey, l_returnflag, l_quantity FROM lineitem WHERE l_quantity < 2""")
def sql_union_all(t):
    """SQL `UNION ALL` over filtered views."""
    a = t.orders.selectExpr("o_custkey AS user", "o_orderpriority AS product", "o_totalprice AS amount")
    b = t.lineitem.selectExpr("l_suppkey AS user", "l_returnflag AS product", "l_quantity AS amount")
    return t.spark.sql("SELECT * FROM {a} WHERE amount > 400000 UNION ALL SELECT * FROM {b} WHERE amount < 2",
                       a=a, b=b)


_SQL_WORDS_VIEW = "v AS (SELECT l_returnflag || l_linestatus AS word, CAST(l_quantity AS BIGINT) AS counts FROM lineitem)"


def _words_view(t):
    return t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("word"),
                             F.col("l_quantity").cast("bigint").alias("counts"))


@query("sql_group_sum", sql=f"WITH {_SQL_WORDS_VIEW} SELECT word, CAST(sum(counts) AS BIGINT) AS counts FROM v GROUP BY word")
def sql_group_sum(t):
    """L1: view with a column list + `SELECT word, SUM(counts) … GROUP BY`."""
    view = _words_view(t).toDF("word", "counts")
    return t.spark.sql("SELECT word, SUM(counts) AS counts FROM {wc} GROUP BY word", wc=view)


@query("table_group_order", sql=f"WITH {_SQL_WORDS_VIEW} SELECT word, CAST(sum(counts) AS BIGINT) AS counts FROM v GROUP BY word ORDER BY counts DESC")
def table_group_order(t):
    """DSL groupBy → select → orderBy(counts.desc)."""
    return _words_view(t).groupBy("word").agg(F.sum("counts").alias("counts")).orderBy(F.col("counts").desc())


@query("retract_changelog", sql="""
WITH o AS (SELECT o_orderstatus AS k, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
w AS (SELECT o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 1)
SELECT false AS is_add, o.k, o.n FROM o LEFT JOIN w USING (k) WHERE o.n IS DISTINCT FROM w.n
UNION ALL SELECT true, w.k, w.n FROM w LEFT JOIN o USING (k) WHERE o.n IS DISTINCT FROM w.n""")
def retract_changelog(t):
    """Retract stream between two versions of an aggregate: (false,
    old) for every changed/removed group, (true, new) for every
    changed/added group."""
    from rivulet.operators.changelog import retract_changes

    o = t.orders
    old = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) \
        .groupBy(F.col("o_orderstatus").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    new = o.groupBy(F.col("o_orderstatus").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return retract_changes(old, new, ["k"])
