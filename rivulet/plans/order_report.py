"""The real-time order report: JSON order records → open orders → IP →
(province, city) → money, then national / per-province / key-city totals
and a national total per UTC+8 day. The same functions serve batch
DataFrames and streaming DataFrames (see `rivulet.streaming.report`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.dates import parse_ts_or_now
from rivulet.functions.parse import MONEY, ipv4_to_long, ipv4_to_string
from rivulet.operators.rangejoin import bucketed_range_join

# JSON field names of an order record, the status code of an
# open order, the national key and the time format of `orderTime`.
ORDER_SCHEMA = ("orderId STRING, userId STRING, orderTime STRING, ip STRING, "
                "orderMoney DOUBLE, orderStatus INT")
OPEN_STATUS = 0
NATIONAL_KEY = "全国"
ORDER_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# status codes of the generated records: O(pen)=0, P(artial)=2 (closed), F(inished)=3 (done)
STATUS_CODES = {"O": 0, "P": 2, "F": 3}


def order_records_from_orders(orders: DataFrame) -> DataFrame:
    """Render the `orders` table as JSON order records (`value` column),
    with an IPv4 address derived from the order key."""
    code = F.lit(None).cast("int")
    for k, v in STATUS_CODES.items():
        code = F.when(F.col("o_orderstatus") == k, F.lit(v)).otherwise(code)
    ip = (F.col("o_orderkey") * 2654435761) % 4294967296
    rec = F.struct(F.col("o_orderkey").cast("string").alias("orderId"),
                   F.col("o_custkey").cast("string").alias("userId"),
                   F.date_format("o_orderdate", ORDER_TIME_FORMAT).alias("orderTime"),
                   ipv4_to_string(ip).alias("ip"),
                   F.col("o_totalprice").alias("orderMoney"),
                   code.alias("orderStatus"))
    return orders.select(F.to_json(rec).alias("value"))


def parse_records(records: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON order records as typed columns (orderId, userId, order_time,
    ip_num, money, status)."""
    o = records.select(F.from_json(F.col(value_col), ORDER_SCHEMA).alias("o")).select("o.*")
    return o.select("orderId", "userId", parse_ts_or_now("orderTime", ORDER_TIME_FORMAT).alias("order_time"),
                    ipv4_to_long("ip").alias("ip_num"), F.col("orderMoney").cast(MONEY).alias("money"),
                    F.col("orderStatus").alias("status"))


def typed_orders(orders: DataFrame) -> DataFrame:
    """The open orders of the `orders` table in the columns of
    `parse_records`; the status filter reaches the scan."""
    code = next(k for k, v in STATUS_CODES.items() if v == OPEN_STATUS)
    o = orders.where(F.col("o_orderstatus") == code)
    return o.select(F.col("o_orderkey").cast("string").alias("orderId"), F.col("o_custkey").cast("string").alias("userId"),
                    F.date_trunc("second", "o_orderdate").cast("timestamp_ntz").alias("order_time"),
                    ((F.col("o_orderkey") * 2654435761) % 4294967296).alias("ip_num"),
                    F.col("o_totalprice").cast(MONEY).alias("money"), F.lit(OPEN_STATUS).alias("status"))


def etl(orders: DataFrame, segments: DataFrame) -> DataFrame:
    """Keep open orders and locate the IP of typed orders. `segments` has
    (seg_start, seg_end, province, city)."""
    o = orders.where(F.col("status") == OPEN_STATUS)
    j = bucketed_range_join(o, segments, "ip_num", bits=18)
    return j.select("orderId", "userId", "order_time", "province", "city", "money")


def national_total(etl_df: DataFrame) -> DataFrame:
    """Running national total under the constant key."""
    return etl_df.agg(F.sum("money").alias("amount")).select(F.lit(NATIONAL_KEY).alias("global"), "amount")


def province_totals(etl_df: DataFrame) -> DataFrame:
    """Total per province."""
    return etl_df.groupBy("province").agg(F.sum("money").alias("amount"))


def city_totals(etl_df: DataFrame, key_cities: Sequence[str]) -> DataFrame:
    """Total for a fixed list of key cities (isin on a short literal list)."""
    return etl_df.where(F.col("city").isin(list(key_cities))).groupBy("city").agg(F.sum("money").alias("amount"))


def all_levels(etl_df: DataFrame, key_cities: Sequence[str]) -> DataFrame:
    """N1–N3 in one pass over one ETL result: GROUPING SETS ((), (province),
    (city)) with the city level restricted to key cities. An order without a
    region counts for the province with a null name."""
    spark = etl_df.sparkSession
    g = spark.sql(f"""
        SELECT CASE WHEN grouping(province) = 0 THEN 'province'
                    WHEN grouping(city) = 0 THEN 'city' ELSE 'global' END AS level,
               CASE WHEN grouping(province) = 0 THEN province
                    WHEN grouping(city) = 0 THEN city ELSE '{NATIONAL_KEY}' END AS name, sum(money) AS amount
        FROM {{e}} GROUP BY GROUPING SETS ((), (province), (city))""", e=etl_df)
    return g.where((F.col("level") != "city") | F.col("name").isin(list(key_cities)))


def daily_totals(etl_df: DataFrame, ts: str = "order_time") -> DataFrame:
    """National total per UTC+8 day (1-day windows shifted by -8 h)."""
    w = F.window(ts, "1 day", "1 day", "-8 hours")
    g = etl_df.groupBy(w.alias("w")).agg(F.sum("money").alias("amount"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    F.lit(NATIONAL_KEY).alias("global"), "amount")


def level_rows(etl_df: DataFrame, key_cities: Sequence[str]) -> DataFrame:
    """Each order once per report level it counts for: national, its
    province, and its city when that is a key city. One aggregation over
    (level, name) then serves all three reports (also on a stream)."""
    entries = F.array(
        F.struct(F.lit("global").alias("level"), F.lit(NATIONAL_KEY).alias("name")),
        F.struct(F.lit("province").alias("level"), F.col("province").alias("name")),
        F.when(F.col("city").isin(list(key_cities)),
               F.struct(F.lit("city").alias("level"), F.col("city").alias("name"))))
    return etl_df.select(F.inline(F.filter(entries, lambda e: e.isNotNull())), "money")
