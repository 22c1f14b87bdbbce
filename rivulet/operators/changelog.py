"""Changelogs and upserts: retract/add rows between two versions of a
keyed result, and keep-latest-version upserts for file/table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def retract_changes(old: DataFrame, new: DataFrame, keys: Sequence[str],
                    flag: str = "is_add") -> DataFrame:
    """Changelog from `old` to `new` (both keyed by `keys`): `(false, old
    row)` for each key whose row changed or disappeared, `(true, new row)`
    for each key whose row changed or appeared. One full outer join; a null
    key is a key like any other."""
    keys = list(keys)
    vals = [c for c in new.columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct(*vals).alias("_o"))
    n = new.select(*keys, F.struct(*vals).alias("_n"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_old_{k}").eqNullSafe(F.col(k))
    j = o.join(n, same, "full")
    j = j.select(*[F.coalesce(F.col(k), F.col(f"_old_{k}")).alias(k) for k in keys], "_o", "_n")
    changed = ~F.col("_o").eqNullSafe(F.col("_n"))
    entries = F.array(
        F.when(changed & F.col("_o").isNotNull(), F.struct(F.lit(False).alias(flag), F.col("_o").alias("r"))),
        F.when(changed & F.col("_n").isNotNull(), F.struct(F.lit(True).alias(flag), F.col("_n").alias("r"))))
    x = j.select(*keys, F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("_e"))
    return x.select(F.col(f"_e.{flag}").alias(flag), *keys, *[F.col(f"_e.r.{c}").alias(c) for c in vals])


def upsert_latest(base: DataFrame, updates: DataFrame, keys: Sequence[str],
                  version: str | None = None) -> DataFrame:
    """`REPLACE INTO` semantics on a table: the latest version per key wins.
    Without `version`, rows of `updates` replace rows of `base`. Of rows with
    equal versions (a key updated twice) the greatest by its other columns, in
    their order, wins, so the result does not depend on the order of the rows.
    A partial aggregate (`max`), so a key with many versions stays cheap."""
    keys = list(keys)
    vals = [c for c in base.columns if c not in keys and c != version]
    if version is None:
        b = base.withColumn("_v", F.lit(0))
        u = updates.withColumn("_v", F.lit(1))
        version = "_v"
    else:
        b, u = base, updates
    allr = b.unionByName(u)
    g = allr.groupBy(*keys).agg(F.max(F.struct(version, *vals)).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in vals])
