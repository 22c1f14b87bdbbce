"""A retract stream: a grouped aggregate as a changelog, (true, new row) and
before it (false, the row given last) for every group that a micro-batch changes."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class Changelog(StatefulProcessor):
    """Per group: the count and the sum given last. A salted group's
    rows come as partial counts and sums, so a call sees few rows."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.given = handle.getValueState("given", "n LONG, total LONG, version LONG")

    def handleInputRows(self, key, rows, timerValues):
        known = self.given.exists()
        n, total, version = self.given.get() if known else (0, 0, 0)
        more_n = more = 0
        for pdf in rows:  # only the sums are kept
            more_n, more = more_n + int(pdf["n"].sum()), more + int(pdf["total"].sum())
        changes = [(False, n, total, version)] if known else []
        if more_n or more or not known:
            n, total, version = n + more_n, total + more, version + 1
            changes.append((True, n, total, version))
            self.given.update((n, total, version))
            out = pd.DataFrame(changes, columns=["is_add", "n", "total", "version"])
            for c, v in reversed(list(zip(self.keys, key))):
                out.insert(1, c, v)
            yield out

    def close(self) -> None:
        pass


def retract_stream(stream: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """The changelog of (count, sum of the bigint `value`) by `keys`: is_add,
    the keys, n, total and version, the number of the row among its group's
    (a retract has the number of the row it takes back). Null values add nothing."""
    kinds = dict(stream.dtypes)
    total = F.coalesce(F.col(value).cast("bigint"), F.lit(0).cast("bigint")) if value else F.lit(0).cast("bigint")
    rows = stream.select(*keys, F.lit(1).cast("bigint").alias("n"), total.alias("total"))
    cols = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    return rows.groupBy(*keys).transformWithStateInPandas(
        Changelog(keys), f"is_add boolean, {cols}, n bigint, total bigint, version bigint", "Append", "None")


def replayed(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table a changelog leaves: of every group the row that was added
    and not taken back. `open_rows` and `loose_retracts` count the rows left (1)
    and the retracts without an earlier add (0) of each group."""
    rows = changes.groupBy(*keys, "version", "n", "total").agg(
        F.sum(F.when(F.col("is_add"), 1).otherwise(-1)).alias("net"))
    return rows.groupBy(*keys).agg(
        F.max_by("n", F.when(F.col("net") > 0, F.col("version"))).alias("n"),
        F.max_by("total", F.when(F.col("net") > 0, F.col("version"))).alias("total"),
        F.sum(F.greatest("net", F.lit(0))).alias("open_rows"), F.sum(F.greatest(-F.col("net"), F.lit(0))).alias("loose_retracts"))
