"""Broadcast state fed by a stream: updates and facts arrive in one stream of
tagged rows, and every fact sees the last update of its key at or before it.

State lies in map state by key inside (bucket of keys, salt). A fact goes to one
salt of its bucket, an update to all of them, so the facts of a hot key
are spread over `salts` tasks at the price of as many copies of the updates."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class LastUpdate(StatefulProcessor):
    """Rows (key, at, is_fact, id, entry): puts out (id, key, entry) for
    every fact, entry being the JSON of the last update (null before any).
    Inside a micro-batch rows are taken by time, updates first at equal times,
    then by id; a row that comes in a later batch than it should sees the state as it is."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "key STRING", "entry STRING")

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["key", "at", "is_fact", "id"], kind="stable")
        out = []
        for k, g in pdf.groupby("key", sort=False, dropna=False):
            name = ("v" + k,) if isinstance(k, str) else ("n",)
            update = ~g["is_fact"].to_numpy(bool)
            # the number of updates seen so far picks the entry: 0 is the state's
            seen = update.cumsum()
            entries = g["entry"].to_numpy(object)[update]
            if not update.all():
                before = self.last.getValue(name)[0] if self.last.containsKey(name) else None
                fact, known = g[~update], [before, *entries]
                out.append(pd.DataFrame({"id": fact["id"].to_numpy(), "key": k if isinstance(k, str) else None,
                                         "entry": [known[i] for i in seen[~update]]}))
            if len(entries):
                self.last.updateValue(name, (entries[-1],))
        if out:
            yield pd.concat(out, ignore_index=True).astype({"id": "int64"})

    def close(self) -> None:
        pass


def with_last_update(rows: DataFrame, key: str, id_col: str, ts_us: str, is_fact: str, values: Sequence[str],
                     buckets: int = 64, salts: int = 4) -> DataFrame:
    """The facts of a stream of tagged rows as (id, key, values…): the values of
    the last update row of the same key (its nulls included; null before the
    first). `is_fact` is a boolean column, `ts_us` epoch microseconds,
    `id_col` a bigint that breaks ties. A null key is a key like any other."""
    entry = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    kinds = dict(rows.dtypes)
    all_salts = F.array(*[F.lit(i) for i in range(salts)])
    own_salt = F.array(F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int"))
    tagged = rows.select(
        F.col(key).cast("string").alias("key"), F.col(ts_us).alias("at"), F.col(is_fact).alias("is_fact"), F.col(id_col).alias("id"),
        F.when(~F.col(is_fact), entry).alias("entry"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"),
        F.explode(F.when(F.col(is_fact), own_salt).otherwise(all_salts)).alias("salt"))
    out = tagged.groupBy("bucket", "salt").transformWithStateInPandas(
        LastUpdate(), "id bigint, key string, entry string", "Append", "None")
    schema = ", ".join(f"`{v}` {kinds[v]}" for v in values)
    return out.select(F.col("id").alias(id_col), F.col("key").cast(kinds[key]).alias(key), F.from_json("entry", schema).alias("e")) \
        .select(id_col, key, *[F.col(f"e.{v}").alias(v) for v in values])
