"""Session-window join on streams: rows are tagged with their session as they
come, and tagged rows are paired by a join. The state of a key is two times, so
that a session of any length is never held in one place; the keys of a bucket
are handled at once."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.streaming.buckets import BUCKETS, dealt, named, numbered
from rivulet.streaming.stateful import _in_order


class SessionTags(StatefulProcessor):
    """Per bucket of keys: ValueState (key, first, last) of the open sessions, as
    arrays, in epoch microseconds. Every row comes out with the first time of its
    session; a session that ends comes out once more without a row (is_left
    null): when a later row of its key is further than the gap away, or by the
    bucket's timer, at the earliest end of an open session, when the watermark
    is."""

    COLUMNS = ["key", "session", "is_left", "id"]

    def __init__(self, gap_us: int, key_kind: str):
        self.gap, self.key_kind = gap_us, key_kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", f"key ARRAY<{self.key_kind}>, first ARRAY<LONG>, last ARRAY<LONG>")
        self.timer = handle.getValueState("timer", "ms LONG")

    def _ends(self, last):
        """The first millisecond that is further than the gap from `last`."""
        return (last + self.gap) // 1000 + 1

    def _frame(self, key, session, is_left, ids) -> pd.DataFrame:
        out = pd.DataFrame({"key": key, "session": session, "is_left": is_left, "id": ids}, columns=self.COLUMNS)
        return out.astype({"session": "int64", "is_left": "boolean", "id": "Int64"})

    def _load(self) -> tuple:
        import numpy as np

        keys, first, last = self.open.get() if self.open.exists() else ([], [], [])
        return list(keys), np.asarray(first, np.int64), np.asarray(last, np.int64)

    def _store(self, keys: list, first, last) -> None:
        old = self.timer.get()[0] if self.timer.exists() else None
        nxt = int(self._ends(int(last.min()))) if len(keys) else None
        if old is not None and old != nxt:
            self.handle.deleteTimer(old)
        if nxt is None:
            self.open.clear()
            self.timer.clear()
            return
        self.open.update((keys, first.tolist(), last.tolist()))
        if old != nxt:
            self.handle.registerTimer(nxt)
            self.timer.update((nxt,))

    def handleInputRows(self, key, rows, timerValues):
        import numpy as np

        cols = _in_order(rows, ["key", "keyed", "ts_us", "id", "is_left"], ["ts_us", "id"])
        held, first, last = self._load()
        codes, keys = numbered(held, cols["key"], cols["keyed"])
        by = np.argsort(codes, kind="stable")
        codes, ts, ids, left = codes[by], cols["ts_us"][by], cols["id"][by], cols["is_left"][by]
        head = np.concatenate([[True], codes[1:] != codes[:-1]])  # the first row of each key
        at = np.flatnonzero(head)
        came = codes[at]
        # a new key's session begins with its first row
        new = came >= len(held)
        first, last = (np.concatenate([x, np.zeros(len(keys) - len(held), np.int64)]) for x in (first, last))
        first[came[new]] = last[came[new]] = ts[at[new]]
        until = np.maximum(last[codes], np.where(head, last[codes], np.roll(ts, 1)))  # before the row
        starts = ts - until > self.gap
        place = np.arange(len(ts))
        start = np.maximum.accumulate(np.where(starts, place, -1))
        own = start >= at[np.cumsum(head) - 1]
        session = np.where(own, ts[start], first[codes])
        yield self._frame(named(keys, codes), session, left, ids)
        if starts.any():
            before = np.where(head, first[codes], np.roll(session, 1))
            yield self._frame(named(keys, codes[starts]), before[starts], None, None)
        end = np.concatenate([at[1:], [len(ts)]]) - 1
        first[came], last[came] = session[end], np.maximum(last[came], ts[end])
        self._store(keys, first, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # every session that the watermark has passed has ended, not only the one of this timer
        fire = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        self.timer.clear()
        keys, first, last = self._load()
        ended = self._ends(last) <= fire
        self._store([k for k, e in zip(keys, ended.tolist()) if not e], first[~ended], last[~ended])
        if ended.any():
            yield self._frame(named(keys, ended), first[ended], None, None)

    def close(self) -> None:
        pass


def session_tags(stream: DataFrame, key: str, ts: str, id_col: str, is_left: str, gap_seconds: int,
                 buckets: int = BUCKETS) -> DataFrame:
    """(key, session, is_left, id) of the rows of a stream with a watermark on
    `ts`, and a row with null is_left and id for each session that has ended:
    sessions of a key whose rows are at most `gap_seconds` apart, named by their
    first time. Rows of a key must come in the order of their micro-batches
    (`runner.run_in_time_order`), inside a micro-batch in any order; a row from
    before the open session counts to it. Rows with a null key or time are left
    out."""
    kind = dict(stream.dtypes)[key]
    rows = dealt(stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()), key, buckets, F.col(ts).alias("ts"),
                 F.unix_micros(ts).alias("ts_us"), F.col(id_col).cast("long").alias("id"), F.col(is_left).alias("is_left"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        SessionTags(gap_seconds * 1_000_000, kind), f"key {kind}, session bigint, is_left boolean, id bigint",
        "Append", "EventTime")


def session_pairs(tags: DataFrame) -> DataFrame:
    """(key, l_id, r_id): every left row with every right row of its session,
    for the sessions that have ended. Equi-joins on (key, session), whose skewed
    partitions Spark splits at run time."""
    on = ["key", "session"]
    ended = tags.where(F.col("is_left").isNull()).select(*on)
    left = tags.where(F.col("is_left")).select(*on, F.col("id").alias("l_id")).join(ended, on, "left_semi")
    return left.join(tags.where(~F.col("is_left")).select(*on, F.col("id").alias("r_id")), on).select("key", "l_id", "r_id")
