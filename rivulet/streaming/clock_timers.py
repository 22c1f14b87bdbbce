"""Processing-time timers: orders that are not paid within a delay of their
arrival, by the clock of the job and not by the times in the rows, are
cancelled."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.session import scratch_path

PLACED, PAID = "placed", "paid"


class ClockTimeout(StatefulProcessor):
    """ListState of a bucket's open orders (order_id, due ms), one
    processing-time timer at the earliest of them, and MapState of payments that
    came before their order, which Spark drops after `ttl_ms`. With a clock
    handed in the timer only ticks every `tick_ms`, and the clock says what is
    due."""

    def __init__(self, delay_ms: int, ttl_ms: int, clock: Callable[[], int] | None, tick_ms: int = 100):
        self.delay, self.ttl, self.clock, self.tick = delay_ms, ttl_ms, clock, tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "order_id LONG, due LONG")
        self.timer = handle.getValueState("timer", "ms LONG")
        self.early = handle.getMapState("early", "order_id LONG", "ms LONG", ttlDurationMs=self.ttl)

    def _now(self, timerValues) -> int:
        return self.clock() if self.clock else timerValues.getCurrentProcessingTimeInMs()

    def _load(self) -> pd.DataFrame:
        rows = list(self.open.get()) if self.open.exists() else []
        return pd.DataFrame([tuple(r) for r in rows], columns=["order_id", "due"], dtype="int64")

    def _store(self, opens: pd.DataFrame, timerValues) -> None:
        old = self.timer.get()[0] if self.timer.exists() else None
        if old is not None:
            self.handle.deleteTimer(old)
        if not len(opens):
            self.open.clear()
            self.timer.clear()
            return
        self.open.put(list(zip(opens["order_id"].tolist(), opens["due"].tolist())))
        at = timerValues.getCurrentProcessingTimeInMs() + self.tick if self.clock else int(opens["due"].min())
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues):
        now = self._now(timerValues)
        pdf = pd.concat(list(rows), ignore_index=True)
        opens = self._load()
        placed = pdf.loc[pdf["kind"] == PLACED, "order_id"].drop_duplicates()
        new = pd.DataFrame({"order_id": placed[~placed.isin(opens["order_id"])], "due": now + self.delay})
        opens = pd.concat([opens, new], ignore_index=True).astype("int64")
        early = {k[0] for k in self.early.keys()} if self.early.exists() else set()
        payments = set(pdf.loc[pdf["kind"] == PAID, "order_id"].tolist())
        paid = opens["order_id"].isin(early | payments)
        matched = set(opens.loc[paid, "order_id"].tolist())
        for i in early & matched:
            self.early.removeKey((i,))
        for i in payments - matched - early:
            self.early.updateValue((i,), (now,))
        self._store(opens[~paid], timerValues)
        if matched:
            yield pd.DataFrame({"order_id": opens.loc[paid, "order_id"], "status": "paid"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.clear()
        opens = self._load()
        due = opens["due"] <= self._now(timerValues)
        self._store(opens[~due], timerValues)
        if due.any():
            yield pd.DataFrame({"order_id": opens.loc[due, "order_id"], "status": "cancelled"})

    def close(self) -> None:
        pass


def timeout_by_clock(stream: DataFrame, id_col: str, kind_col: str, delay_ms: int, buckets: int = 64,
                     ttl_ms: int = 86_400_000, clock: Callable[[], int] | None = None) -> DataFrame:
    """(order_id, status): an order (kind 'placed') is 'paid' when its payment
    (kind 'paid') has come before or comes within `delay_ms` of its arrival, and
    'cancelled' once otherwise. A payment without an order waits for one for
    `ttl_ms`; a payment of a cancelled order has no effect but that. An order
    placed again while it is open changes nothing; rows with a null id are left
    out.

    Orders have nothing to do with each other, so they are dealt to `buckets` by
    a hash and no buyer is hot; a bucket's open orders and its rows of a
    micro-batch are handled at once. `clock` (epoch ms, called in tasks) stands in
    for the clock of the job."""
    rows = stream.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("order_id"), F.col(kind_col).alias("kind"),
        F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(buckets)).alias("bucket"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        ClockTimeout(delay_ms, ttl_ms, clock), "order_id bigint, status string", "Append", "ProcessingTime")


def run_by_clock(stream: DataFrame, name: str, wait_ms: int, checkpoint: str, path: str | None = None,
                 every: str = "200 milliseconds", limit_s: float = 3600) -> DataFrame:
    """Run an append-mode query with processing-time timers into a Parquet
    sink until a micro-batch without input has begun `wait_ms` after the last
    one with input; return the sink read back. The next call goes on from the
    checkpoint; its timers, also those of the calls before, fire from its first
    input on, since Spark begins no micro-batch without any before that. Timers make
    such a query run for ever, so the end of the input is no end of it."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, f"{name}-out")
    q = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .option("path", path).trigger(processingTime=every).start())
    begun, wait = time.monotonic(), dt.timedelta(milliseconds=wait_ms)
    start = last = dt.datetime.now(dt.timezone.utc)
    try:
        while q.isActive:
            done = [(dt.datetime.fromisoformat(p["timestamp"]), p["numInputRows"]) for p in q.recentProgress]
            last = max([last, *(at for at, n in done if n)])
            # without any input there is nothing to wait for but the timers of an earlier run
            if any(at > last + wait and (last > start or not n) for at, n in done):
                break
            if time.monotonic() - begun > limit_s:
                raise TimeoutError(f"{name} did not come to rest within {limit_s} s")
            time.sleep(0.1)
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(path)
