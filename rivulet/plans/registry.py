"""Registry binding named queries (and their DuckDB oracle SQL) to the
library's operators. `__spark_entry__` exposes it to the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.plans.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}
oracles = _ORACLE


def query(key: str, sql: str | None = None):
    """Register `fn(t: Tables) -> DataFrame` under `key`."""

    def wrap(fn):
        if key in _QUERIES:
            raise ValueError(f"duplicate query {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[key] = run
        if sql is not None:
            _ORACLE[key] = sql.strip()
        return fn

    return wrap


def _load_all() -> None:
    # importing the query modules fills the registry
    from rivulet.plans import (  # noqa: F401
        q_basic, q_joins, q_aggs, q_windows, q_report, q_misc, q_stream, q_tables)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)
