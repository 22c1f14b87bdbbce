"""Aggregations: whole-row min-by with a tie rule, user-defined incremental
aggregates (create / add / merge / result) evaluated partial-then-final,
pairwise reduce, group reduce, and observed counters."""

from __future__ import annotations

import pickle
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def min_by_row(df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str],
               cols: Sequence[str]) -> DataFrame:
    """`minBy(field)`: per group the whole row with the smallest `by`, ties
    broken by `tie`. `min(struct(...))` is a partial aggregate, so a large
    group never sits in one task."""
    fields = list(dict.fromkeys([by, *tie, *[c for c in cols if c not in keys]]))
    m = F.min(F.struct(*[F.col(c) for c in fields])).alias("_m")
    g = df.groupBy(*keys).agg(m) if keys else df.agg(m)
    return g.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in fields])


KEYS_HELD = 100_000


class Aggregator:
    """An incremental aggregate function. Subclasses implement `zero`,
    `add(acc, pdf)` (fold a pandas batch of one group into the accumulator),
    `merge(a, b)` and `result(acc)`."""

    def zero(self):
        raise NotImplementedError

    def add(self, acc, pdf):
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, acc):
        raise NotImplementedError


def incremental_aggregate(df: DataFrame, keys: Sequence[str], agg: Aggregator,
                          columns: Sequence[str], out: str, out_type: str) -> DataFrame:
    """Evaluate `agg` per key like a built-in aggregate: each input
    partition folds its rows into one accumulator per key (`mapInPandas`),
    then the partial accumulators of a key are merged (`applyInPandas`): one per
    partition, or one for every KEYS_HELD keys of a partition with more, as a
    task passes its accumulators on when it holds that many. No group is ever
    buffered whole."""
    import pandas as pd

    keys, columns = list(keys), list(columns)

    def partial(batches):
        accs: dict = {}
        for pdf in batches:
            if len(pdf) == 0:
                continue
            for k, g in (pdf.groupby(keys, sort=False, dropna=False) if keys else [((), pdf)]):
                k = k if isinstance(k, tuple) else (k,)
                accs[k] = agg.add(accs.get(k, agg.zero()), g[columns])
            if len(accs) >= KEYS_HELD:
                yield packed(accs)
                accs = {}
        yield packed(accs)

    def packed(accs):
        return pd.DataFrame([(*k, pickle.dumps(a)) for k, a in accs.items()], columns=[*keys, "_acc"])

    key_types = ", ".join(f"`{k}` {t}" for k, t in df.select(*keys).dtypes)
    schema_p = f"{key_types}, _acc binary" if keys else "_acc binary"
    parts = df.select(*keys, *columns).mapInPandas(partial, schema_p)

    def final(pdf):
        acc = agg.zero()
        for b in pdf["_acc"]:
            acc = agg.merge(acc, pickle.loads(b))
        row = {k: [pdf[k].iloc[0]] for k in keys}
        row[out] = [agg.result(acc)]
        return pd.DataFrame(row)

    schema_f = f"{key_types}, `{out}` {out_type}" if keys else f"`{out}` {out_type}"
    if keys:
        return parts.groupBy(*keys).applyInPandas(final, schema_f)
    return parts.groupBy(F.lit(0).alias("_all")).applyInPandas(
        lambda pdf: final(pdf), schema_f)


class UnscaledSum(Aggregator):
    """Exact sum of a bigint column of unscaled decimals (cents) as an
    incremental aggregate; the result is a decimal with `scale` digits. Nulls
    are skipped."""

    def __init__(self, column: str, scale: int = 2):
        self.column, self.scale = column, scale

    def zero(self):
        return 0

    def add(self, acc, pdf):
        v = pdf[self.column].dropna().to_numpy("int64")
        # summed in two halves, so that no batch overflows
        return acc + (int((v >> 32).sum()) << 32) + int((v & 0xFFFFFFFF).sum())

    def merge(self, a, b):
        return a + b

    def result(self, acc):
        from decimal import Decimal

        return Decimal(acc).scaleb(-self.scale)


class UfuncReduce(Aggregator):
    """`reduce(f)` with an associative, commutative numpy ufunc (a vectorised
    binary function, e.g. `numpy.gcd`); nulls are skipped."""

    def __init__(self, column: str, f):
        self.column, self.f = column, f

    def zero(self):
        return None

    def add(self, acc, pdf):
        v = pdf[self.column].dropna().to_numpy("int64")
        return acc if not len(v) else self.merge(acc, self.f.reduce(v).item())

    def merge(self, a, b):
        return b if a is None else a if b is None else self.f(a, b).item()

    def result(self, acc):
        return acc


def reduce_pairs(df: DataFrame, keys: Sequence[str], column: str, f, out: str, out_type: str) -> DataFrame:
    """`groupBy(k).reduce(f)` of a bigint column for an arbitrary associative
    and commutative numpy ufunc (use a built-in aggregate when one exists)."""
    return incremental_aggregate(df, keys, UfuncReduce(column, f), [column], out, out_type)


def observe_count(df: DataFrame, name: str = "counter", extra: dict[str, Column] | None = None):
    """Accumulator: count rows flowing through `df`; read `obs.get` after an
    action. Returns (observed DataFrame, Observation)."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [c.alias(k) for k, c in (extra or {}).items()]
    return df.observe(obs, *metrics), obs
