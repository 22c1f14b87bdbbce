"""Kafka framing: the payload columns a Kafka writer takes, and replay-safe
dedup. (No Kafka jar is part of this environment.)"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kafka_frame(df: DataFrame, key: str | Column, value_cols: Sequence[str | Column],
                keep: Sequence[str] = ()) -> DataFrame:
    """Rows → (key, value) with a JSON value, the shape a Kafka writer takes
    (`keep` columns are carried along for bookkeeping)."""
    k = F.col(key) if isinstance(key, str) else key
    return df.select(*keep, k.cast("string").alias("key"), F.to_json(F.struct(*value_cols)).alias("value"))


def dedup_replay(df: DataFrame, id_cols: Sequence[str], watermark_col: str | None = None,
                 delay: str | None = None) -> DataFrame:
    """Replay-safe output: drop repeated messages by id. On a stream the state
    holds every id, unless an event-time column and a `delay` are given: then
    it is bounded by the watermark (`dropDuplicatesWithinWatermark`), and rows
    that come later than the delay are dropped, first ones too."""
    if watermark_col and delay and df.isStreaming:
        return df.withWatermark(watermark_col, delay).dropDuplicatesWithinWatermark(list(id_cols))
    return df.dropDuplicates(list(id_cols))
