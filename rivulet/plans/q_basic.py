"""Registered queries: word count, text, projections, filters, scalar
functions (SURVEY §2.B, D1, E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import text as TX
from rivulet.plans.registry import query

# DuckDB spelling of the line → trimmed line → words chain used by the oracles.
_SQL_LINES = r"""
lines AS (
  SELECT doc_id, regexp_replace(
           regexp_replace(l, '\r\z', ''), '\A[\x00-\x20]+|[\x00-\x20]+\z', '', 'g') AS t
  FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '\n\z', ''), chr(10))) AS l
        FROM documents)),
words AS (
  SELECT doc_id, unnest(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+')) AS word
  FROM lines WHERE length(t) > 0)
"""


@query("word_count", sql=f"WITH {_SQL_LINES} SELECT word, count(*) AS count FROM words GROUP BY word")
def word_count(t):
    """D1 flagship: lines → non-blank → trim/split → groupBy(word).count."""
    return TX.word_count(TX.document_words(t.documents.select("text")))


@query("top_k_words", sql=f"""WITH {_SQL_LINES}, wc AS (SELECT word, count(*) AS count FROM words GROUP BY word)
SELECT word, count FROM wc ORDER BY count DESC, word ASC LIMIT 3""")
def top_k_words(t):
    """Sort by count desc + first(3), ties broken by the word."""
    wc = TX.word_count(TX.document_words(t.documents.select("text")))
    return TX.top_k(wc, 3, by="count", tie="word")


@query("flat_map_words", sql=f"""WITH {_SQL_LINES}
SELECT doc_id, count(*) AS n_words, count(DISTINCT word) AS n_distinct FROM words GROUP BY doc_id""")
def flat_map_words(t):
    """B2: flatMap line → words, summarised per document."""
    w = TX.document_words(t.documents.select("doc_id", "text"), keep=("doc_id",))
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"),
                                   F.countDistinct("word").alias("n_distinct"))


@query("filter_blank", sql=f"""WITH {_SQL_LINES}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE length(t) > 0) AS n_nonblank
FROM lines GROUP BY doc_id""")
def filter_blank(t):
    """Keep non-null, non-blank lines (JVM trim), counted per document."""
    from rivulet.functions.text import not_blank

    lines = TX.explode_lines(t.documents.select("doc_id", "text"), keep=("doc_id",))
    return lines.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count(F.when(not_blank("line"), 1)).alias("n_nonblank"))


@query("date_rollup_keys", sql="""
SELECT k AS date_key, count(*) AS count FROM (
  SELECT unnest([strftime(ts, '%Y-%m-%d-%H'), strftime(ts, '%Y-%m-%d'), strftime(ts, '%Y-%m')]) AS k
  FROM events) GROUP BY k""")
def date_rollup_keys(t):
    """flatMap each event time to hour/day/month keys, then count."""
    from rivulet.operators.basic import date_rollup

    keys = date_rollup(t.events.select("ts"), "ts")
    return keys.groupBy("date_key").agg(F.count(F.lit(1)).alias("count"))


@query("filter_eq", sql="SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'")
def filter_eq(t):
    """Equality filter (pushed into the Parquet scan)."""
    return t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "value")


_SQL_FIELD_LINES = """
lines AS (SELECT event_id, concat(event_id, ',', user_id, ',',
    CASE WHEN event_type = 'view' THEN '' ELSE event_type END,
    CASE WHEN value > 50 THEN concat(',', user_id) ELSE '' END) AS line FROM events)"""


def _field_lines(t):
    e = t.events
    return e.select("event_id", F.concat(
        e.event_id.cast("string"), F.lit(","), e.user_id.cast("string"), F.lit(","),
        F.when(e.event_type == "view", F.lit("")).otherwise(e.event_type),
        F.when(e.value > 50, F.concat(F.lit(","), e.user_id.cast("string"))).otherwise(F.lit(""))
    ).alias("line"))


@query("filter_field_count", sql=f"""WITH {_SQL_FIELD_LINES}
SELECT event_id, line FROM lines
WHERE len(string_split(regexp_replace(line, ',+\\z', ''), ',')) = 3""")
def filter_field_count(t):
    """Keep lines with exactly 3 comma fields, counted the JVM way
    (trailing empty fields do not count)."""
    from rivulet.functions.text import field_count

    lines = _field_lines(t)
    return lines.where(field_count("line", ",") == 3)


@query("filter_range", sql="SELECT p_partkey, p_size FROM part WHERE p_size > 5 AND p_size < 26")
def filter_range(t):
    """Open range filter."""
    p = t.part
    return p.where((p.p_size > 5) & (p.p_size < 26)).select("p_partkey", "p_size")


@query("parse_lines", sql="""
WITH l AS (SELECT concat_ws(',', (epoch_us(ts) // 1000), user_id, event_type, value) AS line FROM events),
p AS (SELECT string_split(line, ',') AS f FROM l)
SELECT CAST(f[1] AS BIGINT) AS ts_ms, CAST(f[2] AS BIGINT) AS user_id, f[3] AS event_type,
       CAST(f[4] AS DOUBLE) AS value, make_timestamp(CAST(f[1] AS BIGINT) * 1000) AS ts FROM p""")
def parse_lines(t):
    """Render events as `epoch_ms,user,type,value` lines, then parse
    them back into typed fields."""
    from rivulet.functions.dates import epoch_ms, from_epoch_ms
    from rivulet.functions.parse import parse_delimited

    e = t.events
    lines = e.select(F.concat_ws(",", epoch_ms("ts").cast("string"), e.user_id.cast("string"),
                                 e.event_type, e.value.cast("string")).alias("line"))
    parsed = lines.select(*parse_delimited("line", [("ts_ms", "bigint"), ("user_id", "bigint"),
                                                    ("event_type", "string"), ("value", "double")]))
    return parsed.withColumn("ts", from_epoch_ms("ts_ms"))


@query("json_parse", sql="SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_parse(t):
    """JSON text → typed fields with an explicit schema."""
    from rivulet.functions.parse import from_json_fields

    e = t.events
    return e.select("event_id", from_json_fields("props", "k BIGINT").getField("k").alias("k"))


@query("json_render", sql="""
SELECT o_orderkey, to_json(struct_pack(o_orderkey := o_orderkey, o_orderstatus := o_orderstatus,
    o_totalprice := CAST(o_totalprice AS DECIMAL(18,2)),
    o_orderdate := strftime(o_orderdate, '%Y-%m-%d')))::VARCHAR AS json FROM orders""")
def json_render(t):
    """Record → JSON string."""
    from rivulet.functions.parse import money, to_json_row

    o = t.orders
    return o.select("o_orderkey", to_json_row(
        o.o_orderkey, o.o_orderstatus, money(o.o_totalprice).alias("o_totalprice"),
        F.date_format(o.o_orderdate, "yyyy-MM-dd").alias("o_orderdate")).alias("json"))


@query("fn_string", sql="""
SELECT doc_id, lower(substring(text, 1, 24)) AS head, length(text) AS n_len,
       concat(lang, '-', source) AS tag, contains(text, 'the') AS has_the,
       printf('%s:%d', source, n_chars) AS label, upper(lang) AS lang_u FROM documents""")
def fn_string(t):
    """String functions."""
    d = t.documents
    return d.select("doc_id", F.lower(F.substring("text", 1, 24)).alias("head"),
                    F.length("text").cast("bigint").alias("n_len"),
                    F.concat("lang", F.lit("-"), "source").alias("tag"),
                    F.col("text").contains("the").alias("has_the"),
                    F.format_string("%s:%d", "source", "n_chars").alias("label"),
                    F.upper("lang").alias("lang_u"))


@query("fn_date", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_str, (epoch_us(ts) // 1000) AS ts_ms,
       strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts_sec,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts_milli_str FROM events""")
def fn_date(t):
    """Format epoch time, parse back."""
    from rivulet.functions.dates import epoch_ms, parse_ts

    e = t.events
    s = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return e.select("event_id", s.alias("ts_str"), epoch_ms("ts").alias("ts_ms"),
                    parse_ts(s, "yyyy-MM-dd HH:mm:ss").alias("ts_sec"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts_milli_str"))


@query("fn_math", sql="""
SELECT l_orderkey, l_linenumber, l_quantity + 1 AS qty_plus1, l_orderkey % 7 AS mod7,
       l_orderkey >> 3 AS shr3,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS net,
       ((l_orderkey % 1000) / 1000.0) * ((l_orderkey % 1000) / 1000.0)
         + ((l_partkey % 1000) / 1000.0) * ((l_partkey % 1000) / 1000.0) < 1 AS in_circle
FROM lineitem""")
def fn_math(t):
    """Arithmetic, modulo, shift, HALF_UP money, unit-circle test."""
    from rivulet.functions.parse import money

    li = t.lineitem
    x = (li.l_orderkey % 1000) / 1000.0
    y = (li.l_partkey % 1000) / 1000.0
    return li.select("l_orderkey", "l_linenumber", (li.l_quantity + 1).alias("qty_plus1"),
                     (li.l_orderkey % 7).alias("mod7"), F.shiftright("l_orderkey", 3).alias("shr3"),
                     (money(li.l_extendedprice) * (1 - money(li.l_discount))).cast("decimal(18,2)").alias("net"),
                     (x * x + y * y < 1).alias("in_circle"))


_SQL_IP = "(o_orderkey * 2654435761) % 4294967296"


@query("ipv4_convert", sql=f"""
WITH i AS (SELECT o_orderkey, {_SQL_IP} AS ip FROM orders),
d AS (SELECT o_orderkey, ip, concat_ws('.', (ip >> 24) & 255, (ip >> 16) & 255, (ip >> 8) & 255, ip & 255) AS dotted FROM i)
SELECT o_orderkey, ip, dotted,
       CAST(string_split(dotted, '.')[1] AS BIGINT) * 16777216 + CAST(string_split(dotted, '.')[2] AS BIGINT) * 65536
       + CAST(string_split(dotted, '.')[3] AS BIGINT) * 256 + CAST(string_split(dotted, '.')[4] AS BIGINT) AS back
FROM d""")
def ipv4_convert(t):
    """Int ↔ dotted IPv4, over an address derived from the order key."""
    from rivulet.functions.parse import ipv4_to_long, ipv4_to_string

    o = t.orders.select("o_orderkey", ((F.col("o_orderkey") * 2654435761) % 4294967296).alias("ip"))
    d = o.withColumn("dotted", ipv4_to_string("ip"))
    return d.withColumn("back", ipv4_to_long("dotted"))


@query("split_select", sql="""
SELECT event_id, 'odd' AS tag FROM events WHERE event_id % 2 = 1
UNION ALL SELECT event_id, 'even' FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 'high' FROM events WHERE value >= 90""")
def split_select(t):
    """Route each event to named outputs (odd/even id, high value);
    every output at once as (event_id, tag)."""
    from rivulet.operators.basic import explode_routes, with_routes

    e = t.events.select("event_id", "value")
    routed = with_routes(e, {"odd": e.event_id % 2 == 1, "even": e.event_id % 2 == 0,
                             "high": e.value >= 90})
    return explode_routes(routed).select("event_id", "tag")


@query("side_outputs", sql="""
SELECT event_id, 'main' AS tag, CAST(event_id AS VARCHAR) AS payload FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, 'error', concat(user_id, ':', event_type) FROM events WHERE event_type = 'error'
UNION ALL SELECT event_id, 'high_value', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) FROM events WHERE value > 90""")
def side_outputs(t):
    """Main output plus two side outputs of other shapes in one pass."""
    from rivulet.functions.parse import money
    from rivulet.operators.basic import side_outputs as so

    e = t.events
    return so(e, main=e.event_type != "error",
              main_payload=e.event_id,
              sides={"error": (e.event_type == "error",
                               F.concat(e.user_id.cast("string"), F.lit(":"), e.event_type)),
                     "high_value": (e.value > 90, money(e.value))},
              keep=("event_id",))


@query("first_n", sql="SELECT least(10, count(*)) AS n_rows, true AS all_members FROM orders")
def first_n(t):
    """first(10) of an unsorted set: any ten rows, so the result tells
    how many came and whether all of them are rows of the table."""
    from rivulet.operators.basic import first_n as fn

    o = t.orders.select("o_orderkey", "o_orderstatus")
    some = fn(o, 10)
    known = o.distinct().withColumn("member", F.lit(True))
    got = some.join(known, ["o_orderkey", "o_orderstatus"], "left")
    return got.agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.coalesce("member", F.lit(False))).alias("all_members"))


@query("map_project", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, year(o_orderdate) AS o_year,
       o_totalprice * 2 AS doubled, o_orderkey + 1 AS next_key FROM orders""")
def map_project(t):
    """B1: map = projection with computed columns."""
    o = t.orders
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").cast("bigint").alias("o_year"),
                    (o.o_totalprice * 2).alias("doubled"), (o.o_orderkey + 1).alias("next_key"))
