"""Time-ordered lookups per key, built on the balanced scan: as-of
(latest dimension version at or before a row) and "next event within a
timeout" (the batch twin of a keyed timer)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.scan import Running, keyed_scan
from rivulet.operators.windows import epoch_us, from_epoch_us


def asof_join(facts: DataFrame, dims: DataFrame, key: str, ts: str, tie: str,
              values: Sequence[str], prefix: str = "dim_") -> DataFrame:
    """For each fact row, the dimension columns of the last dimension row of
    the same key with `dim.ts <= fact.ts` (broadcast state: the last write
    replaces the whole entry, nulls included; a row before its key's first
    update sees null).
    Facts and dimension updates are merged into one ordered scan per key, so
    neither side is broadcast and a hot key is split across tasks."""
    role = "_role"
    entry = F.struct(*[F.col(v).alias(v) for v in values])
    kind = dims.select(entry.alias("e")).schema["e"].dataType
    f = facts.select(*facts.columns, F.lit(None).cast(kind).alias("_entry"), F.lit(1).alias(role))
    d = dims.select(*[F.lit(None).cast(facts.schema[c].dataType).alias(c)
                      for c in facts.columns if c not in (key, ts, tie)],
                    F.col(key), F.col(ts), F.col(tie), entry.alias("_entry"), F.lit(0).alias(role))
    u = f.unionByName(d).withColumn("_ts_us", epoch_us(ts))
    # at equal time the dimension update comes first (dim.ts <= fact.ts)
    r = keyed_scan(u, [key], ["_ts_us", role, tie], [Running("_entry", "last", "_asof")])
    return r.where(F.col(role) == 1).select(
        *facts.columns, *[F.col("_asof").getField(v).alias(prefix + v) for v in values])


def next_within(facts: DataFrame, events: DataFrame, key: str, ts: str, tie: str,
                within_seconds: int, out: str = "next_ts") -> DataFrame:
    """For each fact row, the time of the first `events` row of the same
    key strictly after it, if that is at most `within_seconds` later (else
    null). A reverse-time scan per key — no pairs are formed."""
    role = "_role"
    f = facts.withColumn("_ev_us", F.lit(None).cast("bigint")).withColumn(role, F.lit(0))
    e = events.select(*[F.lit(None).cast(facts.schema[c].dataType).alias(c)
                        for c in facts.columns if c not in (key, ts, tie)],
                      F.col(key), F.col(ts), F.col(tie),
                      epoch_us(ts).alias("_ev_us"), F.lit(1).alias(role))
    u = f.unionByName(e).withColumn("_neg_us", -epoch_us(ts))
    # reverse time; at equal time the fact comes first so it does not see
    # an event at the very same instant (strictly after)
    r = keyed_scan(u, [key], ["_neg_us", role, tie], [Running("_ev_us", "last", "_next_us")])
    r = r.where(F.col(role) == 0)
    limit = epoch_us(ts) + within_seconds * 1_000_000
    nxt = F.when(F.col("_next_us") <= limit, from_epoch_us("_next_us"))
    return r.withColumn(out, nxt).drop(role, "_ev_us", "_neg_us", "_next_us")
