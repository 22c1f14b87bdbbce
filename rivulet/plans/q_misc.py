"""Registered queries: partitioning, sources, sinks, iteration, Python
operator surface (SURVEY §2.A, G, K, M, O, P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.parse import money
from rivulet.operators import partitioning as P
from rivulet.plans.q_basic import _SQL_LINES
from rivulet.plans.registry import query


def _parts(t) -> int:
    return int(t.spark.conf.get("spark.sql.shuffle.partitions"))


@query("partition_custom", sql="SELECT o_orderkey, CAST(o_orderkey % 2 AS INTEGER) AS pid FROM orders")
def partition_custom(t):
    """Custom partitioner key % 2 — each row lands in partition key % 2."""
    o = t.orders.select("o_orderkey")
    return P.tag_partition(P.by_custom(o, 2, F.col("o_orderkey") % 2))


@query("partition_hash_invariant", sql="SELECT true AS ok, count(DISTINCT o_custkey) AS n_keys FROM orders")
def partition_hash_invariant(t):
    """Hash partitioning puts every key in exactly one partition."""
    return P.hash_invariant(t.orders, "o_custkey", _parts(t))


@query("partition_range_invariant", sql="SELECT true AS ok, count(*) AS n_rows FROM lineitem")
def partition_range_invariant(t):
    """Range partitions hold ordered, disjoint value ranges."""
    return P.range_invariant(t.lineitem, "l_extendedprice", _parts(t))


@query("rebalance_counts", sql="SELECT true AS ok, count(*) AS n_rows FROM part WHERE p_size > 5 AND p_size < 26")
def rebalance_counts(t):
    """G1: round-robin rebalance after a filter gives balanced partitions."""
    p = t.part.where((F.col("p_size") > 5) & (F.col("p_size") < 26))
    return P.balance_invariant(p, _parts(t))


@query("sort_partitions", sql="SELECT true AS ok, count(*) AS n_rows FROM part")
def sort_partitions(t):
    """Every partition sorted on its own, descending."""
    return P.sorted_invariant(t.part.repartition(_parts(t)), "p_retailprice")


@query("rescale_forward", sql="SELECT true AS ok, count(*) AS n_rows FROM part")
def rescale_forward(t):
    """Rescale to half the partitions without a shuffle; forward keeps rows."""
    return P.rescale_invariant(t.part.repartition(_parts(t)), max(1, _parts(t) // 2))


@query("shuffle_random", sql="SELECT true AS ok, count(*) AS n_rows FROM orders")
def shuffle_random(t):
    """Random redistribution spreads the rows evenly."""
    return P.shuffle_invariant(t.orders.select("o_orderkey"), _parts(t))


def _log(t):
    from rivulet.sources.log import events_as_log

    return events_as_log(t.events)


@query("log_start_offsets", sql="""
WITH log AS (SELECT CAST(user_id % 3 AS INTEGER) AS partition, event_id AS "offset", ts FROM events),
s AS (SELECT * FROM (VALUES (0, 2000), (1, 5000)) v(partition, start))
SELECT log.partition, "offset", ts FROM log JOIN s ON log.partition = s.partition WHERE "offset" >= start""")
def log_start_offsets(t):
    """A10: start a log read from explicit per-partition offsets; a
    partition without one follows the `latest` reset policy."""
    from rivulet.sources.log import StartPosition, start_from

    pos = StartPosition().from_earliest().from_offsets({0: 2000, 1: 5000})  # last call wins
    return start_from(_log(t), pos).select("partition", "offset", "ts")


@query("log_start_timestamp", sql="""
WITH log AS (SELECT CAST(user_id % 3 AS INTEGER) AS partition, event_id AS "offset", ts FROM events),
s AS (SELECT partition, min("offset") AS start FROM log WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1)
SELECT log.partition, "offset", ts FROM log JOIN s ON log.partition = s.partition WHERE "offset" >= start""")
def log_start_timestamp(t):
    """A10: start every partition at its first offset with a timestamp at
    or after the given time."""
    from rivulet.sources.log import StartPosition, start_from

    pos = StartPosition().from_timestamp("2024-01-15 00:00:00")
    return start_from(_log(t), pos).select("partition", "offset", "ts")


@query("log_start_position", sql="""
WITH log AS (SELECT CAST(user_id % 3 AS INTEGER) AS partition, event_id AS "offset", ts FROM events)
SELECT partition, "offset", ts FROM log WHERE partition <> 0 OR "offset" >= 3000""")
def log_start_position(t):
    """Committed group offsets where a partition has one (partition
    0 at 3000), the `earliest` reset policy for the others."""
    from rivulet.sources.log import StartPosition, start_from

    pos = StartPosition().from_latest().from_group_offsets({0: 3000})
    return start_from(_log(t), pos, default="earliest").select("partition", "offset", "ts")


@query("src_elements", sql="""
SELECT coalesce(label, 'other') AS label, count(*) AS n FROM events
LEFT JOIN (VALUES ('view', 'browse'), ('purchase', 'buy')) v(event_type, label) USING (event_type) GROUP BY 1""")
def src_elements(t):
    """A1: a literal collection used as a lookup over all events."""
    from rivulet.sources.basic import from_elements

    lits = from_elements(t.spark, [("view", "browse"), ("purchase", "buy")], "event_type string, label string")
    e = t.events.select("event_type").join(lits, "event_type", "left")
    return e.groupBy(F.coalesce("label", F.lit("other")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("src_sequence", sql="""
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
r AS (SELECT unnest(range(lo, hi + 1)) AS id FROM b)
SELECT id, o_orderkey IS NOT NULL AS present FROM r LEFT JOIN orders ON id = o_orderkey""")
def src_sequence(t):
    """A2: generateSequence(from, to) inclusive over the order-key range,
    flagged by whether an order has that key."""
    from rivulet.sources.basic import sequence

    o = t.orders.select("o_orderkey")
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    seq = sequence(t.spark, lo, hi)
    keys = o.select(F.col("o_orderkey").alias("id"), F.lit(True).alias("present"))
    return seq.join(keys, "id", "left").select("id", F.coalesce("present", F.lit(False)).alias("present"))


@query("dedup_replay", sql="SELECT DISTINCT event_id, event_type FROM events")
def dedup_replay(t):
    """M2: replay-safe output — events plus a replayed slice, deduplicated
    by message id."""
    from rivulet.sinks.kafka import dedup_replay as dd

    e = t.events.select("event_id", "event_type", "ts")
    replay = e.where(F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz"))
    return dd(e.unionByName(replay), ["event_id"]).select("event_id", "event_type")


@query("upsert_latest", sql="""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders""")
def upsert_latest(t):
    """K7: REPLACE INTO semantics — updates (recent orders closed as 'F')
    replace the base row with the same key."""
    from rivulet.operators.changelog import upsert_latest as up

    o = t.orders
    base = o.select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("o_totalprice"))
    upd = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", F.lit("F").alias("o_orderstatus"), money("o_totalprice").alias("o_totalprice"))
    return up(base, upd, ["o_orderkey"])


@query("kafka_payload", sql="""
SELECT event_id, CAST(user_id AS VARCHAR) AS key,
       to_json(struct_pack(event_id := event_id, event_type := event_type, value := CAST(value AS DECIMAL(18,2))))::VARCHAR AS value
FROM events""")
def kafka_payload(t):
    """key/value framing of a JSON payload for a Kafka sink."""
    from rivulet.sinks.kafka import kafka_frame

    e = t.events
    return kafka_frame(e, "user_id", [F.col("event_id"), F.col("event_type"), money("value").alias("value")],
                       keep=("event_id",))


@query("bucketed_write_counts", sql="SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS n FROM events GROUP BY 1")
def bucketed_write_counts(t):
    """K9: bucketed file sink (dt=yyyyMMdd from the record's time); the
    written directory is read back and counted per bucket."""
    from rivulet.session import scratch_path
    from rivulet.sinks.files import read_bucketed, write_bucketed

    path = scratch_path(t.spark, "bucketed")
    write_bucketed(t.events.select("event_id", "ts", "user_id"), path, "ts")
    return read_bucketed(t.spark, path).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("iterate_plus", sql="SELECT p_partkey, p_size + 10 AS p_size FROM part")
def iterate_plus(t):
    """O1: bulk iteration — 10 rounds of `+1`, lineage cut every 4 rounds."""
    from rivulet.operators.iterate import iterate

    p = t.part.select("p_partkey", "p_size")
    return iterate(p, lambda d: d.withColumn("p_size", F.col("p_size") + 1), 10, checkpoint_every=4)


@query("monte_carlo_pi", sql="""
SELECT avg(CASE WHEN x * x + y * y < 1 THEN 1 ELSE 0 END) * 4 AS pi, count(*) AS n FROM (
  SELECT ((l_orderkey * 7919 + l_linenumber * 104729) % 10007) / 10007.0::DOUBLE AS x,
         ((l_partkey * 7919 + l_suppkey * 104729) % 10009) / 10009.0::DOUBLE AS y FROM lineitem)""")
def monte_carlo_pi(t):
    """O2: pi from deterministic pseudo-random points, one per line item."""
    from rivulet.operators.iterate import monte_carlo_pi as mc
    from rivulet.operators.iterate import pseudo_uniform

    li = t.lineitem
    x = pseudo_uniform(F.col("l_orderkey"), F.col("l_linenumber"), modulus=10007)
    y = pseudo_uniform(F.col("l_partkey"), F.col("l_suppkey"), modulus=10009)
    return mc(li.select(x.alias("x"), y.alias("y")), F.col("x"), F.col("y"))


@query("process_udtf", sql=f"""WITH {_SQL_LINES}
SELECT doc_id, count(*) AS n_words FROM words GROUP BY doc_id""")
def process_udtf(t):
    """A ProcessFunction-style flatMap as a Python table function fed
    whole Arrow batches, emitting the words of each non-blank line."""
    from rivulet.operators.process import words_arrow_udtf
    from rivulet.operators.text import explode_lines

    lines = explode_lines(t.documents.select("doc_id", "text"), keep=("doc_id",))
    words = words_arrow_udtf("doc_id", "line")(lines.asTable())
    return words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"))


@query("count_pattern", sql="""
SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper FROM documents""")
def count_pattern(t):
    """P: matches of a pattern per row, as a built-in expression."""
    from rivulet.operators.process import count_pattern as cp

    return cp(t.documents.select("doc_id", "text"), "text", "[A-Z]", "n_upper", keep=("doc_id",))


@query("map_in_pandas_setup", sql="""
SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper FROM documents""")
def map_in_pandas_setup(t):
    """P: a map over Arrow batches with per-partition set-up (the rich
    function's `open`)."""
    from rivulet.operators.process import with_setup

    def setup():
        import pyarrow as pa
        import pyarrow.compute as pc

        others = "[^A-Z]+"  # prepared once per partition
        return lambda text: pc.fill_null(pc.utf8_length(pc.replace_substring_regex(text.cast(pa.string()), others, "")), 0)

    return with_setup(t.documents.select("doc_id", "text"), "text", "n_upper", setup, keep=("doc_id",))


@query("src_text_files", sql="""
SELECT line, count(*) AS n FROM (SELECT event_id || ',' || event_type AS line FROM events) GROUP BY 1""")
def src_text_files(t):
    """A3/A4/K3: lines written as gzipped text into nested folders by the
    text sink and read back recursively."""
    from rivulet.session import scratch_path
    from rivulet.sinks.files import write_text
    from rivulet.sources.basic import read_text

    base = scratch_path(t.spark, "text")
    e = t.events.select("event_id", "event_type")
    line = F.concat_ws(",", F.col("event_id").cast("string"), "event_type")
    write_text(e.where(F.col("event_id") % 2 == 0), f"{base}/even", line, compression="gzip")
    write_text(e.where(F.col("event_id") % 2 != 0), f"{base}/odd/deep", line)
    return read_text(t.spark, base, recursive=True).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query("src_json_lines", sql="SELECT event_id, event_type, value FROM events")
def src_json_lines(t):
    """A5: JSON lines read back with an explicit schema."""
    from rivulet.session import scratch_path
    from rivulet.sources.basic import read_json_lines

    path = scratch_path(t.spark, "json-lines")
    t.events.select("event_id", "event_type", "value").write.json(path)
    return read_json_lines(t.spark, path, "event_id BIGINT, event_type STRING, value DOUBLE")


@query("src_delimited_files", sql="SELECT event_id, user_id, event_type, value FROM events")
def src_delimited_files(t):
    """A5/K4: a `$`-delimited file sink read back with typed columns."""
    from rivulet.session import scratch_path
    from rivulet.sinks.files import write_delimited
    from rivulet.sources.basic import read_delimited

    path = scratch_path(t.spark, "delimited")
    write_delimited(t.events.select("event_id", "user_id", "event_type", "value"), path, sep="$")
    return read_delimited(t.spark, path, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE", sep="$")
