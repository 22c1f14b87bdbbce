"""Joins: equi-joins with default values for the missing side, lookup joins
against small dimensions (broadcast only behind a size check), file-backed
lookups and point-lookup enrichment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the reference's placeholder for a missing join partner ("unknown").
UNKNOWN = "未知"

def fill_missing(df: DataFrame, cols: Sequence[str], default: str = UNKNOWN) -> DataFrame:
    """Replace nulls of string columns coming from a missing join side."""
    return df.select(*[F.coalesce(F.col(c), F.lit(default)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def outer_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str,
               fill: Sequence[str] = (), default: str = UNKNOWN) -> DataFrame:
    """left / right / full outer equi-join; `fill` columns of the missing side
    get `default`. With `on` given as names the key comes from whichever side
    exists (`coalesce`)."""
    joined = left.join(right, on=on, how=how)
    return fill_missing(joined, fill, default) if fill else joined


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
                how: str = "left") -> DataFrame:
    """Enrich `fact` from a dimension (broadcast-variable / distributed-cache
    pattern). A miss gives null (or use `fill_missing`). Whether the dimension
    is broadcast is left to the optimizer: it does so while its size in bytes,
    known from statistics or measured at run time by AQE, is below
    `spark.sql.autoBroadcastJoinThreshold`."""
    return fact.join(dim, on=on, how=how)


def read_lookup_file(spark, path: str, schema: str, sep: str = ",", header: bool = False) -> DataFrame:
    """A lookup file (the distributed-cache file) as a DataFrame; a malformed
    line fails the read."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header, mode="FAILFAST")


def point_lookup_enrich(df: DataFrame, key_col: str, lookup: Callable[[object], object | None],
                        out_col: str, timeout_s: float, out_type: str = "string",
                        max_in_flight: int = 10, on_timeout: str = "unknown",
                        on_miss: str = UNKNOWN) -> DataFrame:
    """Enrichment against a service that only answers point lookups (the
    async-IO pattern). Distinct keys, a null key among them, are looked up once
    with up to `max_in_flight` concurrent requests per task; a miss yields
    `on_miss`. A request slower than `timeout_s` yields `on_timeout` and gives
    its slot to the next one, so with a slow service the result depends on its
    load and may differ when a task is repeated; choose the time accordingly.
    Prefer `lookup_join` whenever the dimension can be read as a table."""
    import threading
    from queue import Queue

    import pandas as pd

    keys = df.select(F.col(key_col).alias("_key")).distinct()

    def run(batches):
        slots = threading.Semaphore(max_in_flight)

        def ask(k):
            answer, done = Queue(1), threading.Event()

            def call():
                try:
                    answer.put(("ok", lookup(k)))
                except Exception as e:  # raised again by the task
                    answer.put(("failed", e))
                done.set()

            def guard():
                threading.Thread(target=call, daemon=True).start()
                done.wait(timeout_s)
                slots.release()

            slots.acquire()
            g = threading.Thread(target=guard, daemon=True)
            g.start()
            return g, answer

        for pdf in batches:
            vals = []
            asked = [ask(None if pd.isna(k) else k) for k in pdf["_key"].tolist()]
            for g, answer in asked:
                g.join()
                kind, v = answer.get() if not answer.empty() else ("late", None)
                if kind == "failed":
                    raise v
                vals.append(on_timeout if kind == "late" else on_miss if v is None else v)
            yield pd.DataFrame({"_key": pdf["_key"], out_col: vals})

    answers = keys.mapInPandas(run, f"_key {dict(df.dtypes)[key_col]}, {out_col} {out_type}")
    return df.join(answers, F.col(key_col).eqNullSafe(F.col("_key")), "left").select(*df.columns, out_col)
