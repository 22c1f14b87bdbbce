"""Sharding by sampled splitters.

A size-weighted sample of the keys gives quantile boundaries that cut the key
space into ranges of about equal bytes; ranges that turn out overfull are
sampled again and subdivided. Rows are numbered inside their range, and one
running total per range places every row on the global byte line, which is cut
into shards of equal length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import partitions
from rivulet.session import written

SALT_BITS = 20


def shard(df: DataFrame, size: Column, key: Column, shards: int = 16, sample: int = 20_000,
          rounds: int = 4) -> DataFrame:
    """`df` with (shard int, slot long): shard 0..shards-1 holds a stretch of
    the rows in the order of `key` (a 64-bit hash), the shards' sums of `size`
    differ from each other by little more than one row, and slot numbers the
    rows of a shard from 0.

    Rows with equal keys are neighbours, so equal groups stay in one shard
    except where a shard boundary falls inside the group. A group of any size
    is spread over ranges, since the lowest bits of its rows' sort keys are a
    hash of the row's number. Null sizes count as 0; a null key is a key like
    any other; equal rows get slots of their own; an empty input gives an empty
    result. Columns named shard or slot are replaced. `sample` bounds the keys
    drawn in each of at most `rounds` rounds.
    """
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    mask = (1 << SALT_BITS) - 1
    rows = df.select(*keep, F.coalesce(size.cast("long"), F.lit(0)).alias("__size"),
                     F.coalesce(key, F.lit(0)).alias("__key"), F.monotonically_increasing_id().alias("__row"))
    rows = rows.withColumn("__key", F.col("__key").bitwiseAND(F.lit(~mask)).bitwiseOR(
        F.xxhash64("__row").bitwiseAND(F.lit(mask))))
    rows = written(rows, "shard-rows")
    n_ranges = max(4 * shards, 2 * partitions(df))
    bounds, totals = _splitters(rows, n_ranges, sample, rounds)

    start_size = np.concatenate([[0], np.cumsum([t[0] for t in totals])])
    start_row = np.concatenate([[0], np.cumsum([t[1] for t in totals])])
    total = max(int(start_size[-1]), 1)
    starts = df.sparkSession.createDataFrame(
        [(i, int(start_size[i]), int(start_row[i])) for i in range(len(totals))],
        "__range int, __bytes long, __rows long")  # one row per range
    w = Window.partitionBy("__range").orderBy("__key", "__row").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("__range", _range_of(bounds)("__key")).join(F.broadcast(starts), "__range")
    placed = placed.select(
        *keep, (F.col("__bytes") * 2 + F.sum("__size").over(w) * 2 - F.col("__size")).alias("__middle2"),
        (F.col("__rows") + F.count(F.lit(1)).over(w) - 1).alias("__number"))
    placed = placed.withColumn("shard", F.least(
        F.lit(shards - 1), F.floor(F.col("__middle2") * shards / F.lit(2 * total))).cast("int")).drop("__middle2")
    placed = written(placed, "shard-placed")
    first = placed.groupBy("shard").agg(F.min("__number").alias("__first"))  # one row per shard
    out = placed.join(F.broadcast(first), "shard")
    return out.select(*keep, "shard", (F.col("__number") - F.col("__first")).alias("slot"))


def _range_of(bounds: np.ndarray):
    @F.pandas_udf("int")
    def find(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(np.int64), side="right").astype(np.int32))
    return find


def _totals(rows: DataFrame, bounds: np.ndarray) -> list[tuple[int, int]]:
    """(bytes, rows) of every range."""
    found = rows.groupBy(_range_of(bounds)("__key").alias("r")).agg(
        F.sum("__size").alias("b"), F.count(F.lit(1)).alias("n")).collect()  # one row per range
    out = [(0, 0)] * (len(bounds) + 1)
    for r in found:
        out[r.r] = (r.b, r.n)
    return out


def _splitters(rows: DataFrame, n_ranges: int, sample: int, rounds: int):
    """Boundaries of about `n_ranges` ranges, and their totals. Each round
    draws a size-weighted sample in the ranges that hold over twice the mean."""
    bounds = np.zeros(0, np.int64)
    totals = _totals(rows, bounds)
    total = sum(b for b, _ in totals)
    for turn in range(rounds):
        mean = total / n_ranges
        full = [i for i, (b, n) in enumerate(totals) if b > 2 * mean and n > 1]
        if not full or not total:
            break
        mass = sum(totals[i][0] for i in full)
        u = F.pmod(F.xxhash64("__row", F.lit(turn)), F.lit(1 << 50)) / float(1 << 50)
        drawn = rows.where(u < F.col("__size") * (sample / mass))
        if len(bounds):
            drawn = drawn.where(_range_of(bounds)("__key").isin(full))
        drawn = drawn.select("__key", F.greatest(F.col("__size").cast("double"), F.lit(mass / sample)).alias("w"))
        drawn = sorted((r[0], r[1]) for r in drawn.collect())  # about `sample` keys
        keys, weight = np.array([k for k, _ in drawn], np.int64), np.array([w for _, w in drawn])
        where = np.searchsorted(bounds, keys, side="right")
        new = [bounds]
        for i in full:
            k, c = keys[where == i], np.cumsum(weight[where == i])
            if len(k):
                parts = max(2, int(np.ceil(totals[i][0] / mean)))
                at = np.searchsorted(c, c[-1] * np.arange(1, parts) / parts)
                new.append(k[np.minimum(at, len(k) - 1)])
        grown = np.unique(np.concatenate(new))
        if len(grown) == len(bounds):
            break
        bounds, totals = grown, _totals(rows, grown)
    return bounds, totals
