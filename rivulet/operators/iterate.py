"""Bulk iteration and the Monte-Carlo estimate of pi."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.session import checkpoint_dir


def iterate(df: DataFrame, step: Callable[[DataFrame], DataFrame], rounds: int,
            checkpoint_every: int = 5) -> DataFrame:
    """Bulk iteration: apply `step` `rounds` times (`iterate(n)…closeWith`).
    Every `checkpoint_every` rounds the lineage is cut with a reliable
    checkpoint in the shared checkpoint folder, so plans stay small and a
    lost executor does not recompute from round 0."""
    checkpoint_dir(df.sparkSession)
    cur = df
    for i in range(1, rounds + 1):
        cur = step(cur)
        if checkpoint_every and i % checkpoint_every == 0 and i < rounds:
            cur = cur.checkpoint(eager=True)
    return cur


def pseudo_uniform(*parts: Column, modulus: int) -> Column:
    """A deterministic value in [0, 1) from integer columns (a hashed point
    coordinate that is reproducible across engines)."""
    acc = F.lit(0).cast("bigint")
    for i, p in enumerate(parts):
        acc = acc + p.cast("bigint") * [7919, 104729, 1299709][i % 3]
    return (F.pmod(acc, F.lit(modulus)) / F.lit(float(modulus)))


def monte_carlo_pi(points: DataFrame, x: Column, y: Column) -> DataFrame:
    """4 × share of points inside the unit quarter circle. Sampling is
    parallel over the rows (one aggregate), not 10 000 sequential rounds."""
    inside = F.when(x * x + y * y < 1, 1).otherwise(0)
    return points.agg((F.avg(inside) * 4).alias("pi"), F.count(F.lit(1)).alias("n"))
