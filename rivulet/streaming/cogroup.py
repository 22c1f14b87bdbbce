"""Window coGroup on streams with logic of one's own: the rows of both sides of
a (key, window) wait in list state until the watermark has passed the window,
then a function gets them, chunk by chunk."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: rows of a chunk
CHUNK = 10_000


class CoGroup(StatefulProcessor):
    """Per (key, window, salt): two lists of rows as JSON and a timer at the
    window's end. Rows of a window that is over are dropped."""

    def __init__(self, fn: Callable, size_ms: int, left: Sequence[str], right: Sequence[str], chunk: int):
        self.fn, self.size, self.columns, self.chunk = fn, size_ms, {"left": list(left), "right": list(right)}, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lists = {s: handle.getListState(s, "row STRING") for s in ("left", "right")}

    def handleInputRows(self, key, rows, timerValues):
        end = int(key[1]) + self.size
        if end <= timerValues.getCurrentWatermarkInMs():
            for _ in rows:
                pass
            return iter(())
        for pdf in rows:
            for side, state in self.lists.items():
                mine = pdf.loc[pdf["side"] == side, "row"].tolist()
                if mine:
                    state.appendList([(x,) for x in mine])
        self.handle.registerTimer(end)
        return iter(())

    def _chunks(self, side: str) -> Iterator[pd.DataFrame]:
        rows = iter(self.lists[side].get()) if self.lists[side].exists() else iter(())
        while part := [json.loads(r[0]) for r in islice(rows, self.chunk)]:
            yield pd.DataFrame(part, columns=self.columns[side])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self.fn(key[0], int(key[1]), lambda: self._chunks("left"), lambda: self._chunks("right"))
        for state in self.lists.values():
            state.clear()

    def close(self) -> None:
        pass


def window_cogroup(rows: DataFrame, key: str, ts: str, is_left: str, left: Sequence[str], right: Sequence[str],
                   window_seconds: int, fn: Callable, schema: str, salts: int = 1, chunk: int = CHUNK) -> DataFrame:
    """coGroup of a stream of tagged rows: those with `is_left` and the others
    meet by `key` and tumbling window of `ts`, which has a watermark.

    `fn(key, window start in ms, left, right)` yields pandas frames of `schema`,
    once for each (key, window) with a row on either side; `left()` and
    `right()` each begin an iterator over frames of at most `chunk` rows with
    the columns named, values as JSON gives them, so no call needs to hold a side. With
    `salts`, the left rows of a (key, window) are dealt over as many calls and
    each gets all right rows: for logic that looks at left rows one by one
    (inner and left joins), not for sums over the right side."""
    size = window_seconds * 1000
    ms = F.unix_millis(F.col(ts))
    packed = F.when(F.col(is_left), F.to_json(F.struct(*left), {"ignoreNullFields": "false"})).otherwise(
        F.to_json(F.struct(*right), {"ignoreNullFields": "false"}))
    every = F.array(*[F.lit(i) for i in range(salts)])
    tagged = rows.select(
        ts, F.col(key).alias("key"), (ms - F.pmod(ms, F.lit(size))).alias("win"), packed.alias("row"),
        F.when(F.col(is_left), F.lit("left")).otherwise(F.lit("right")).alias("side"),
        F.explode(F.when(F.col(is_left), F.array(F.pmod(F.xxhash64(packed), F.lit(salts)).cast("int"))).otherwise(every)).alias("salt"))
    return tagged.groupBy("key", "win", "salt").transformWithStateInPandas(
        CoGroup(fn, size, left, right, chunk), schema, "Append", "EventTime")
