"""Keyed state and timers on streams with `transformWithStateInPandas`:
a per-key counter emitting one updated count per record, and an order
timeout (an open order becomes cancelled when no payment arrives before its
event-time timer fires)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.streaming.buckets import BUCKETS, dealt, named, numbered


def _gathered(rows, columns: list[str]) -> dict:
    """Arrays of the columns of a bucket's rows of a micro-batch. Only these
    columns are kept of the batches that arrive."""
    import numpy as np

    parts = [[pdf[c].to_numpy() for c in columns] for pdf in rows]
    return {c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(columns)}


def _in_order(rows, columns: list[str], order: list[str]) -> dict:
    """`_gathered` rows of a key or bucket, in `order`."""
    import numpy as np

    cols = _gathered(rows, columns)
    by = np.lexsort([cols[c] for c in reversed(order)])
    return {c: v[by] for c, v in cols.items()}


class KeyedCounter(StatefulProcessor):
    """Per bucket of keys: ValueState (key, n) of the counts, as arrays. Emits
    (id, key, running count) per record, records of a key taken in (ts, id)
    order within a micro-batch."""

    def __init__(self, key_kind: str, id_col: str, key_col: str):
        self.key_kind, self.id_col, self.key_col = key_kind, id_col, key_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", f"key ARRAY<{self.key_kind}>, n ARRAY<LONG>")

    def _added(self, codes, keys: list, by) -> tuple:
        """The counts of the keys before and with rows of these keys that add `by` each."""
        import numpy as np

        before = np.zeros(len(keys), np.int64)
        if self.count.exists():
            n = self.count.get()[1]
            before[:len(n)] = n
        after = before.copy()
        np.add.at(after, codes, by)
        self.count.update((keys, after.tolist()))
        return before, after

    def _known(self) -> list:
        return list(self.count.get()[0]) if self.count.exists() else []

    def handleInitialState(self, key, initialState, timerValues):
        codes, keys = numbered(self._known(), initialState["key"], initialState["keyed"])
        self._added(codes, keys, initialState["n"].to_numpy())

    def handleInputRows(self, key, rows, timerValues):
        import numpy as np

        cols = _in_order(rows, ["key", "keyed", "at", "id"], ["at", "id"])
        codes, keys = numbered(self._known(), cols["key"], cols["keyed"])
        before, _ = self._added(codes, keys, 1)
        by = np.argsort(codes, kind="stable")
        codes = codes[by]
        place = np.arange(len(codes)) - np.searchsorted(codes, codes)  # among the rows of the key
        yield pd.DataFrame({self.id_col: cols["id"][by], self.key_col: named(keys, codes), "running": before[codes] + place + 1})

    def close(self) -> None:
        pass


def keyed_counter(stream: DataFrame, key_col: str, id_col: str, ts_col: str, initial: DataFrame | None = None,
                  buckets: int = BUCKETS) -> DataFrame:
    """The running number of every row among its key's. `initial` holds the
    counts (key, n) that a new query begins with, as `exported_counts` gives them."""
    types = dict(stream.dtypes)
    schema = f"{id_col} {types[id_col]}, {key_col} {types[key_col]}, running bigint"
    rows = dealt(stream, key_col, buckets, F.col(ts_col).alias("at"), F.col(id_col).alias("id"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        KeyedCounter(types[key_col], id_col, key_col), schema, "Append", "None",
        initialState=dealt(initial, key_col, buckets, "n").groupBy("bucket") if initial is not None else None)


def exported_counts(spark: SparkSession, checkpoint: str, key_col: str) -> DataFrame:
    """The counts (key, n) in the state of a stopped `keyed_counter` query, read
    from its checkpoint. They do not depend on the number of partitions or
    buckets that the query had, so that one with another number may begin with
    them."""
    state = spark.read.format("statestore").option("stateVarName", "count").load(checkpoint)
    state = state.select(F.explode(F.arrays_zip(F.col("value.key").alias("key"), F.col("value.n").alias("n"))).alias("c"))
    return state.select(F.col("c.key").alias(key_col), F.col("c.n").alias("n"))


class KeyedRunningMax(StatefulProcessor):
    """Per bucket of keys: ValueState (key, max) of the maxima, as arrays (the
    keyed-state max demo). Emits (id, key, running max) per record in (ts, id)
    order. Values arrive with a flag instead of nulls, so integers stay
    integers; a null value changes nothing and repeats the maximum so far (null
    before any)."""

    def __init__(self, key_kind: str, id_col: str, key_col: str, kind: str):
        self.key_kind, self.id_col, self.key_col, self.kind = key_kind, id_col, key_col, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("max", f"key ARRAY<{self.key_kind}>, v ARRAY<{self.kind}>")

    def handleInputRows(self, key, rows, timerValues):
        import numpy as np
        import pyarrow as pa

        cols = _in_order(rows, ["key", "keyed", "at", "id", "value_of", "given"], ["at", "id"])
        held, best = self.best.get() if self.best.exists() else ([], [])
        codes, keys = numbered(list(held), cols["key"], cols["keyed"])
        v = cols["value_of"]
        # the maximum so far comes before the rows of its key, ranks take the place of values: NaN is the
        # largest, 0 stands for none, and the ranks of a later key are all larger
        found, rank = np.unique(np.concatenate([np.asarray(best, v.dtype), v]), return_inverse=True)
        rank = np.where(np.concatenate([np.ones(len(best), bool), cols["given"].astype(bool)]), rank + 1, 0)
        codes = np.concatenate([np.arange(len(best)), codes])
        by = np.argsort(codes, kind="stable")
        codes = codes[by]
        base = codes * (len(found) + 1)
        run = np.maximum.accumulate(base + rank[by]) - base
        last = np.flatnonzero(np.concatenate([codes[1:] != codes[:-1], [True]]))
        last = last[run[last] > 0]
        if len(last):
            self.best.update((named(keys, codes[last]).tolist(), found[run[last] - 1].tolist()))
        row = by >= len(best)
        run, of = run[row], by[row] - len(best)
        out = pd.arrays.ArrowExtensionArray(pa.array(found[np.maximum(run, 1) - 1], mask=run == 0, from_pandas=False))
        yield pd.DataFrame({self.id_col: cols["id"][of], self.key_col: named(keys, codes[row]), "running_max": out})

    def close(self) -> None:
        pass


def keyed_running_max(stream: DataFrame, key_col: str, id_col: str, ts_col: str, value_col: str,
                      buckets: int = BUCKETS) -> DataFrame:
    """Running maximum of a bigint or double column; the result has its type."""
    types = dict(stream.dtypes)
    kind = types[value_col]
    rows = dealt(stream, key_col, buckets, F.col(ts_col).alias("at"), F.col(id_col).alias("id"),
                 F.coalesce(F.col(value_col), F.lit(0).cast(kind)).alias("value_of"), F.col(value_col).isNotNull().alias("given"))
    schema = f"{id_col} {types[id_col]}, {key_col} {types[key_col]}, running_max {kind}"
    return rows.groupBy("bucket").transformWithStateInPandas(
        KeyedRunningMax(types[key_col], id_col, key_col, "LONG" if kind == "bigint" else "DOUBLE"), schema, "Append", "None")


class OrderTimeout(StatefulProcessor):
    """Per bucket of users: the open orders wait in ValueState (arrays of user,
    order id and time). A payment pays every open order of its user placed before
    it within the timeout; one event-time timer per bucket, at the earliest open
    deadline, cancels the orders whose deadline has passed. Each call reads and
    writes the state once and works on whole arrays. Orders without a user are
    never paid. Emits (order_id, status)."""

    def __init__(self, timeout_us: int, key_kind: str, open_kind: str, paid_kind: str):
        self.timeout_us, self.key_kind = timeout_us, key_kind
        self.open_kind, self.paid_kind = open_kind, paid_kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", f"key ARRAY<{self.key_kind}>, order_id ARRAY<LONG>, ts_us ARRAY<LONG>")
        self.timer = handle.getValueState("timer", "ms LONG")

    def _deadline_ms(self, ts_us):
        return -(-(ts_us + self.timeout_us) // 1000)  # ceil to milliseconds

    def _load(self) -> tuple:
        """Keys (object), order ids and times of the open orders."""
        import numpy as np

        keys, ids, ts = self.open.get() if self.open.exists() else ([], [], [])
        return named(keys, slice(None)), np.asarray(ids, np.int64), np.asarray(ts, np.int64)

    def _store(self, keys, ids, ts) -> None:
        old = self.timer.get()[0] if self.timer.exists() else None
        if len(ids) == 0:
            self.open.clear()
            if old is not None:
                self.handle.deleteTimer(old)
                self.timer.clear()
            return
        self.open.update((keys.tolist(), ids.tolist(), ts.tolist()))
        nxt = int(self._deadline_ms(int(ts.min())))
        if nxt != old:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(nxt)
            self.timer.update((nxt,))

    def _paid(self, owner, ts, payer, pays):
        """Which orders have a payment of their owner strictly after them and
        within the timeout. Owners are numbers."""
        import numpy as np

        times, rank = np.unique(np.concatenate([ts, pays]), return_inverse=True)
        pay = payer * len(times) + rank[len(ts):]
        by = np.argsort(pay)
        pay, payer, pays = pay[by], payer[by], pays[by]
        idx = np.searchsorted(pay, owner * len(times) + rank[:len(ts)], side="right")
        at = np.minimum(idx, len(pay) - 1)
        return (idx < len(pay)) & (payer[at] == owner) & (pays[at] <= ts + self.timeout_us)

    def handleInputRows(self, key, rows, timerValues):
        import numpy as np

        cols = _gathered(rows, ["key", "keyed", "kind", "order_id", "at"])
        held, ids, ts = self._load()
        new, pay = (cols["kind"] == k for k in (self.open_kind, self.paid_kind))
        pay &= cols["keyed"].astype(bool)
        codes, keys = numbered(list(dict.fromkeys(held)), cols["key"], cols["keyed"])
        number = {k: i for i, k in enumerate(keys)}
        owner = np.concatenate([np.fromiter((number[k] for k in held), np.int64, len(held)), codes[new]])
        ids = np.concatenate([ids, cols["order_id"][new].astype(np.int64)])
        ts = np.concatenate([ts, cols["at"][new].astype(np.int64)])
        if pay.any() and len(ids):
            paid = self._paid(owner, ts, codes[pay], cols["at"][pay].astype(np.int64))
        else:
            paid = np.zeros(len(ids), dtype=bool)
        self._store(named(keys, owner[~paid]), ids[~paid], ts[~paid])
        if paid.any():
            yield pd.DataFrame({"order_id": ids[paid], "status": "paid"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # every order whose deadline the watermark has passed is due, not
        # only the one this timer was set for
        fire = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        self.timer.clear()
        keys, ids, ts = self._load()
        due = self._deadline_ms(ts) <= fire
        self._store(keys[~due], ids[~due], ts[~due])
        if due.any():
            yield pd.DataFrame({"order_id": ids[due], "status": "cancelled"})

    def close(self) -> None:
        pass


def order_timeout(stream: DataFrame, key_col: str, id_col: str, ts_col: str, kind_col: str,
                  timeout_seconds: int, open_kind: str, paid_kind: str, buckets: int = BUCKETS) -> DataFrame:
    """Event-time timers: `ts_col` holds epoch microseconds; the stream
    needs a watermark on its event-time column. Rows without a time are left out."""
    proc = OrderTimeout(timeout_seconds * 1_000_000, dict(stream.dtypes)[key_col], open_kind, paid_kind)
    rows = dealt(stream.where(F.col(ts_col).isNotNull()), key_col, buckets, F.col(id_col).cast("long").alias("order_id"),
                 F.col(ts_col).alias("at"), F.col(kind_col).alias("kind"),
                 *(F.col(c).alias(f"time{i}") for i, (c, kind) in enumerate(stream.dtypes) if kind == "timestamp"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        proc, "order_id bigint, status string", "Append", "EventTime")


class AllowedLateness(StatefulProcessor):
    """Event-time tumbling window per key with allowed lateness and a late
    side output. A window fires when the watermark passes its end (timer),
    then fires again with the updated total for every late row that arrives
    before end + lateness; rows later than that go to the side output. State
    per (key, window): (total, fired); totals are integers. Rows in time are
    added and late ones put out as they come; only those that fire again, each
    with its own total, are gathered, for one window of a key at a time."""

    COLUMNS = ["kind", "win_start", "key", "total", "event_id"]

    def __init__(self, size_ms: int, lateness_ms: int, ts_col: str, value_col: str, id_col: str):
        self.size, self.lateness = size_ms, lateness_ms
        self.ts_col, self.value_col, self.id_col = ts_col, value_col, id_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.win = handle.getValueState("win", "total LONG, fired BOOLEAN")

    def _frame(self, out):
        df = pd.DataFrame(out, columns=self.COLUMNS)
        return df.astype({"win_start": "int64", "total": "Int64", "event_id": "Int64"})

    def handleInputRows(self, key, rows, timerValues):
        import numpy as np

        wm, w = timerValues.getCurrentWatermarkInMs(), int(key[1])
        end = w + self.size
        if end + self.lateness <= wm:
            for pdf in rows:
                yield self._frame([("side", w, key[0], None, i) for i in pdf[self.id_col].tolist()])
            return
        known = self.win.exists()
        total, fired = self.win.get() if known else (0, False)
        if end > wm:
            for pdf in rows:
                total += int(pdf[self.value_col].to_numpy().sum())
        else:  # due before these rows came: it fires without them, then for each of them
            out = [("fire", w, key[0], total, None)] if known and not fired else []
            cols = _in_order(rows, [self.id_col, self.value_col], [self.id_col])
            sums = total + np.cumsum(cols[self.value_col])
            out += [("late_fire", w, key[0], s, i) for s, i in zip(sums.tolist(), cols[self.id_col].tolist())]
            total, fired = int(sums[-1]), True
            yield self._frame(out)
        if not known:  # a window's end sets the timer of its lateness
            self.handle.registerTimer(end if end > wm else end + self.lateness)
        self.win.update((total, fired))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # a timer stands for the end of the window, or for the end of its lateness
        if not self.win.exists():
            return
        total, fired = self.win.get()
        w = int(key[1])
        last = w + self.size + self.lateness
        if max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) >= last:
            self.win.clear()
        else:
            self.handle.registerTimer(last)
            if not fired:
                self.win.update((total, True))
        if not fired:
            yield self._frame([("fire", w, key[0], total, None)])

    def close(self) -> None:
        pass


def allowed_lateness(stream: DataFrame, key_col: str, ts_ms_col: str, value_col: str, id_col: str,
                     window_seconds: int, lateness_seconds: int) -> DataFrame:
    """Stream of window firings: (kind, win_start ms, key, total, event_id)
    with kind in fire | late_fire | side. `value_col` is a bigint (cents for
    money). The stream needs a watermark; the per-row time goes in `ts_ms_col`
    (epoch ms) so Spark's own late-row filter does not drop the rows this
    operator classifies."""
    proc = AllowedLateness(window_seconds * 1000, lateness_seconds * 1000, ts_ms_col, value_col, id_col)
    ktype = dict(stream.dtypes)[key_col]
    size = F.lit(window_seconds * 1000)
    stream = stream.withColumn("__win", F.col(ts_ms_col) - F.pmod(F.col(ts_ms_col), size))
    return stream.groupBy(key_col, "__win").transformWithStateInPandas(
        proc, f"kind string, win_start bigint, key {ktype}, total bigint, event_id bigint", "Append", "EventTime")
