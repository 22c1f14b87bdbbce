"""Registered queries: the order report."""

from __future__ import annotations

from rivulet.plans import order_report as R
from rivulet.plans.q_joins import _SQL_SEGMENTS, ip_segments
from rivulet.plans.registry import query

# The nine "key cities" of the city report (nation names of
# the generated data stand in for cities).
KEY_CITIES = ("NATION_0", "NATION_3", "NATION_5", "NATION_7", "NATION_9",
              "NATION_11", "NATION_13", "NATION_17", "NATION_21")
_SQL_KEY_CITIES = ", ".join(f"'{c}'" for c in KEY_CITIES)
_DEC = "DECIMAL(28,2)"

_SQL_ETL = f"""{_SQL_SEGMENTS},
etl AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS orderId, CAST(o_custkey AS VARCHAR) AS userId,
         o_orderdate AS order_time, province, city, CAST(o_totalprice AS DECIMAL(18,2)) AS money
  FROM (SELECT *, (o_orderkey * 2654435761) % 4294967296 AS ip FROM orders WHERE o_orderstatus = 'O') o
  LEFT JOIN seg ON ip BETWEEN seg_start AND seg_end)"""


def _etl(t):
    return R.etl(R.typed_orders(t.orders), ip_segments(t))


@query("report_etl", sql=f"WITH {_SQL_ETL} SELECT * FROM etl")
def report_etl(t):
    """JSON order records → open orders → IP region → decimal money."""
    return R.etl(R.parse_records(R.order_records_from_orders(t.orders)), ip_segments(t))


@query("report_global", sql=f"WITH {_SQL_ETL} SELECT '全国' AS global, CAST(sum(money) AS {_DEC}) AS amount FROM etl")
def report_global(t):
    """National total."""
    return R.national_total(_etl(t))


@query("report_province", sql=f"WITH {_SQL_ETL} SELECT province, CAST(sum(money) AS {_DEC}) AS amount FROM etl GROUP BY 1")
def report_province(t):
    """Total per province (region)."""
    return R.province_totals(_etl(t))


@query("report_city", sql=f"""WITH {_SQL_ETL}
SELECT city, CAST(sum(money) AS {_DEC}) AS amount FROM etl WHERE city IN ({_SQL_KEY_CITIES}) GROUP BY 1""")
def report_city(t):
    """Totals of the key cities."""
    return R.city_totals(_etl(t), KEY_CITIES)


@query("report_all_levels", sql=f"""WITH {_SQL_ETL}
SELECT 'global' AS level, '全国' AS name, CAST(sum(money) AS {_DEC}) AS amount FROM etl
UNION ALL SELECT 'province', province, CAST(sum(money) AS {_DEC}) FROM etl GROUP BY province
UNION ALL SELECT 'city', city, CAST(sum(money) AS {_DEC}) FROM etl WHERE city IN ({_SQL_KEY_CITIES}) GROUP BY city""")
def report_all_levels(t):
    """N1–N3 from one ETL result in one pass (grouping sets)."""
    return R.all_levels(_etl(t), KEY_CITIES)


@query("report_daily", sql=f"""WITH {_SQL_ETL}
SELECT time_bucket(INTERVAL '1 day', order_time, TIMESTAMP '2000-01-01 16:00:00') AS window_start,
       time_bucket(INTERVAL '1 day', order_time, TIMESTAMP '2000-01-01 16:00:00') + INTERVAL '1 day' AS window_end,
       '全国' AS global, CAST(sum(money) AS {_DEC}) AS amount FROM etl GROUP BY 1, 2""")
def report_daily(t):
    """National total per UTC+8 day."""
    return R.daily_totals(_etl(t))
