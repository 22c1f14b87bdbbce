"""Stateless record operators: routing (split/select), side outputs,
first-n, date roll-up flatMap."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import dates as D


def with_routes(df: DataFrame, rules: Mapping[str, Column], col: str = "routes") -> DataFrame:
    """`split(selector)`: attach the names of every output a row goes to."""
    tags = [F.when(pred, F.lit(name)) for name, pred in rules.items()]
    return df.withColumn(col, F.filter(F.array(*tags), lambda x: x.isNotNull()))


def explode_routes(routed: DataFrame, col: str = "routes", tag_col: str = "tag") -> DataFrame:
    """All outputs at once, one row per (row, output)."""
    return routed.select("*", F.explode(col).alias(tag_col)).drop(col)


def side_outputs(df: DataFrame, main: Column, sides: Mapping[str, tuple[Column, Column]],
                 main_payload: Column, tag_col: str = "tag",
                 payload_col: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Main output plus N tagged side outputs of other shapes, in one pass:
    each row becomes the (tag, payload) pairs it belongs to. `sides` maps a
    tag to (predicate, payload expression); payloads are rendered as strings
    so outputs of different types share one column. Consumers filter on
    `tag` (or, in streaming, write each tag from `foreachBatch`)."""
    entries = [F.when(main, F.struct(F.lit("main").alias(tag_col),
                                     main_payload.cast("string").alias(payload_col)))]
    for name, (pred, payload) in sides.items():
        entries.append(F.when(pred, F.struct(F.lit(name).alias(tag_col),
                                             payload.cast("string").alias(payload_col))))
    arr = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return df.select(*keep, F.inline(arr))


def first_n(df: DataFrame, n: int) -> DataFrame:
    """`first(n)` of an unsorted set: any n rows (use top_k for a defined
    order)."""
    return df.limit(n)


def date_rollup(df: DataFrame, ts_col: str, key_col: str = "date_key") -> DataFrame:
    """flatMap one timestamp to its hour, day and month keys."""
    return df.select(F.explode(D.rollup_keys(ts_col)).alias(key_col))
