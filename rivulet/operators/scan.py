"""Ordered scans (running aggregates) that stay balanced when one key holds
a large share of the rows, and global sequence numbers without a one-task
window.

A window `OVER (PARTITION BY k ORDER BY t)` sends every row of a key to one
task, and an un-partitioned window sends the whole table to one task. Here
every row is tagged with the number of its range of (keys, order): the range
bounds are quantiles of a sample drawn by a hash of the row's position, so
they are the same whenever they are computed, and a binary search over them
is one expression. A key that spans several ranges is split at them: the
window runs over (range, keys), and a carry per range — the aggregate of the
same key in all earlier ranges — is broadcast and combined. Only keys that a
bound falls into can span ranges, so the carry holds at most two rows per
range. Nothing is written and nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 100
_BOUNDS, _PART = "_scan_bounds", "_scan_part"


@dataclass(frozen=True)
class Running:
    """One running aggregate: `how` in sum | max | count | last (last
    non-null value). `inclusive=False` gives the value over the rows
    strictly before the current one. Nulls are skipped as by SQL aggregates;
    results have the type of the SQL aggregate of the column."""

    value: str | None
    how: str
    out: str
    inclusive: bool = True


def _range_bounds(df: DataFrame, cols: Sequence[str], ranges: int) -> Column:
    """An array of `ranges - 1` quantiles of struct(cols) as a scalar
    subquery over a sample of about `ranges * SAMPLE_PER_RANGE` rows."""
    n = df.agg(F.count(F.lit(1))).scalar()
    share = F.lit(float(ranges * SAMPLE_PER_RANGE * (1 << 30))) / F.greatest(n, F.lit(1))
    keys = df.select(F.struct(*cols).alias("k"))
    drawn = keys.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < share)
    all_keys = drawn.agg(F.sort_array(F.collect_list("k")).alias("a"))
    at = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)),
                     lambda i: F.try_element_at("a", F.greatest(F.lit(1), F.ceil(i * F.size("a") / ranges).cast("int"))))
    return all_keys.select(at.alias("b")).scalar()


def _range_of(key: Column, ranges: int) -> Column:
    """How many bounds are at most `key`: a binary search as a fold over
    halving steps."""
    steps = [1 << i for i in range((ranges - 1).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda lo, s: lo + F.when((lo + s <= ranges - 1) & (F.try_element_at(_BOUNDS, lo + s) <= key), s).otherwise(0))


def with_ranges(df: DataFrame, cols: Sequence[str], ranges: int | None = None) -> DataFrame:
    """`df` tagged with the number (`_scan_part`) of each row's range of
    struct(cols), and the bounds the numbers refer to."""
    ranges = max(2, ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = df.withColumn(_BOUNDS, _range_bounds(df, cols, ranges))
    return d.withColumn(_PART, _range_of(F.struct(*cols), ranges))


def _total(s: Running, order: Sequence[str]) -> Column:
    """The aggregate of a group of rows."""
    if s.how == "count":
        return F.count(F.lit(1))
    v = F.col(s.value)
    if s.how == "sum":
        return F.sum(v)
    if s.how == "max":
        return F.max(v)
    return F.max_by(v, F.when(v.isNotNull(), F.struct(*order)))


def _over(s: Running, value: Column, w) -> Column:
    """The aggregate of a column of values, or of totals, over a window."""
    if s.how in ("sum", "count"):
        return F.sum(value).over(w)
    return F.max(value).over(w) if s.how == "max" else F.last(value, ignorenulls=True).over(w)


def _spanning(keys: Sequence[str]) -> Column:
    """Whether the lower or the upper bound of the row's range falls into its key."""
    spans = F.lit(False) if keys else F.lit(True)
    for bound in (F.try_element_at(_BOUNDS, F.nullif(F.col(_PART), F.lit(0))), F.try_element_at(_BOUNDS, F.col(_PART) + 1)):
        same = bound.isNotNull() if keys else F.lit(True)
        for k in keys:
            same = same & bound.getField(k).eqNullSafe(F.col(k))
        spans = spans | same
    return spans


def _with_carry(d: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = F.col(_PART) == F.col("_carry_part")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_carry_key_{k}"))
    # at most two rows per range
    return d.join(F.broadcast(carry), on, "left")


def keyed_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               specs: Sequence[Running], ranges: int | None = None) -> DataFrame:
    """Add running aggregates per `keys` in `order`. The order columns must
    make rows unique within a key (end with an id); nulls sort first and a
    null key is a key of its own. `keys=()` scans the whole table in one
    order."""
    keys, order, specs = list(keys), list(order), list(specs)
    d = with_ranges(df, keys + order, ranges)

    totals = d.where(_spanning(keys)).groupBy(_PART, *keys).agg(*[_total(s, order).alias(f"_total_{s.out}") for s in specs])
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col(_PART).alias("_carry_part"), *[F.col(k).alias(f"_carry_key_{k}") for k in keys],
                          *[_over(s, F.col(f"_total_{s.out}"), before).alias(f"_carry_{s.out}") for s in specs])
    j = _with_carry(d.drop(_BOUNDS), carry, keys)

    out = []
    for s in specs:
        w = Window.partitionBy(_PART, *keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, 0 if s.inclusive else -1)
        local = F.count(F.lit(1)).over(w) if s.how == "count" else _over(s, F.col(s.value), w)
        c = F.col(f"_carry_{s.out}")
        if s.how in ("sum", "count"):
            both = F.coalesce(local + c, local, c)
        else:
            both = F.greatest(local, c) if s.how == "max" else F.coalesce(local, c)
        out.append(both.alias(s.out))
    return j.select(*df.columns, *out)


def global_seq(df: DataFrame, order: Sequence[str], out: str = "seq", ranges: int | None = None) -> DataFrame:
    """Dense 1-based row number over the whole table in `order` (a total
    order), without a one-task window."""
    return keyed_scan(df, (), order, [Running(None, "count", out)], ranges)


def session_scan(df: DataFrame, keys: Sequence[str], ts_us: str, tie: str, gap_us: int,
                 out: str = "session_start_us", ranges: int | None = None) -> DataFrame:
    """Start (epoch µs) of each row's session per key: a session breaks
    when the previous row of the key is more than `gap_us` earlier. One scan:
    a range's carry holds the last time and the last opening of the key
    before it; whether the first row of a range opens a session follows from
    the last time, so openings are known per range before they are carried."""
    keys, order = list(keys), [ts_us, tie]
    d = with_ranges(df, keys + order, ranges)
    w = Window.partitionBy(_PART, *keys).orderBy(*order)
    ts, before = F.col(ts_us), Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_prev", F.max(ts_us).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    totals = d.where(_spanning(keys)).groupBy(_PART, *keys).agg(
        F.min(ts_us).alias("_first"), F.max(ts_us).alias("_last"), F.max(F.when(ts - F.col("_prev") > gap_us, ts)).alias("_inner"))
    totals = totals.withColumn("_until", F.max("_last").over(before))
    first_opens = F.col("_until").isNull() | (F.col("_first") - F.col("_until") > gap_us)
    totals = totals.withColumn("_opened", F.coalesce("_inner", F.when(first_opens, F.col("_first"))))
    carry = totals.select(F.col(_PART).alias("_carry_part"), *[F.col(k).alias(f"_carry_key_{k}") for k in keys],
                          F.col("_until"), F.max("_opened").over(before).alias("_opened"))
    j = _with_carry(d.drop(_BOUNDS), carry, keys)
    prev = F.coalesce("_prev", "_until")
    j = j.withColumn("_opens", F.when(prev.isNull() | (ts - prev > gap_us), ts))
    local = F.max("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return j.select(*df.columns, F.greatest(local, F.col("_opened")).alias(out))
