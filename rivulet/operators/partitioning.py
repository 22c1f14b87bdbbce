"""Data placement (the reference's partitioners). The physical number of a
hash partition is engine specific, so callers check invariants (one
partition per key, non-overlapping ranges, balanced sizes) rather than ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PID = "pid"


def tag_partition(df: DataFrame, col: str = PID) -> DataFrame:
    """Row tagged with the index of the task that holds it."""
    return df.withColumn(col, F.spark_partition_id())


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round-robin redistribution (repairs skew after a filter)."""
    return df.repartition(n)


def by_hash(df: DataFrame, n: int, *cols: str) -> DataFrame:
    return df.repartition(n, *cols)


def by_range(df: DataFrame, n: int, *cols: str) -> DataFrame:
    return df.repartitionByRange(n, *cols)


def by_custom(df: DataFrame, n: int, partition_expr: Column) -> DataFrame:
    """Custom partitioner: rows go to partition `partition_expr` (an int in
    [0, n)), e.g. `key % 2`."""
    return df.repartitionById(n, partition_expr.cast("int"))


def forward(df: DataFrame) -> DataFrame:
    """Keep the current placement (no shuffle)."""
    return df


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Local round robin to fewer tasks without a shuffle."""
    return df.coalesce(n)


def shuffle_random(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Random redistribution (seeded, so a retried task sends rows to the
    same place)."""
    return df.repartition(n, F.rand(seed))


def sort_partitions(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sort every partition on its own, without a shuffle."""
    return df.sortWithinPartitions(*order)


def sorted_invariant(df: DataFrame, col: str) -> DataFrame:
    """One row: whether every partition is in descending order of `col` after
    `sort_partitions`, and the row count. `monotonically_increasing_id`
    numbers the rows of a partition in their order."""
    from pyspark.sql import Window

    p = sort_partitions(df.select(col), F.desc(col)).select(
        col, F.spark_partition_id().alias(PID), F.monotonically_increasing_id().alias("place"))
    def follows(before: Column, value: Column) -> Column:  # nulls come last
        return before.isNull() | value.isNull() | F.coalesce(before[col] >= value, F.lit(False))

    # neighbours inside blocks of rows, so no partition is gathered whole
    p = p.withColumn("block", F.shiftright("place", 10))
    w = Window.partitionBy(PID, "block").orderBy("place")
    row = F.struct(col)
    inside = p.select(PID, "place", "block", row.alias("row"), follows(F.lag(row).over(w), F.col(col)).alias("ok"))
    blocks = inside.groupBy(PID, "block").agg(
        F.bool_and("ok").alias("ok"), F.count(F.lit(1)).alias("n_rows"),
        F.min_by("row", "place").alias("first"), F.max_by("row", "place").alias("last"))
    # and across the edges of the blocks: a row for each 1024 of a partition
    edge = follows(F.lag("last").over(Window.partitionBy(PID).orderBy("block")), F.col("first")[col])
    return blocks.select((F.col("ok") & edge).alias("ok"), "n_rows").agg(
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))


def rescale_invariant(df: DataFrame, n: int) -> DataFrame:
    """One row: whether `rescale` keeps all rows in at most `n` partitions and
    `forward` keeps every row where it is."""
    r = tag_partition(rescale(df, n)).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(PID).alias("parts"))
    same = forward(tag_partition(df)).select(F.col(PID) == F.spark_partition_id()).toDF("same").agg(
        F.bool_and("same").alias("same"))
    return r.join(same, F.lit(True)).select(((F.col("parts") <= n) & F.col("same")).alias("ok"), "n_rows")


def shuffle_invariant(df: DataFrame, n: int) -> DataFrame:
    """One row: whether a random redistribution gives every partition between
    half and twice its share, and the row count."""
    b = tag_partition(shuffle_random(df, n)).groupBy(PID).agg(F.count(F.lit(1)).alias("c"))
    return b.agg(((F.max("c") <= 2 * F.sum("c") / n) & (F.min("c") >= F.sum("c") / n / 2)).alias("ok"),
                 F.sum("c").alias("n_rows"))


def hash_invariant(df: DataFrame, key: str, n: int) -> DataFrame:
    """One row: whether every key sits in exactly one partition after a hash
    repartition, and the number of keys."""
    p = tag_partition(by_hash(df.select(key), n, key))
    per_key = p.groupBy(key).agg(F.countDistinct(PID).alias("n_parts"))
    return per_key.agg((F.max("n_parts") == 1).alias("ok"), F.count(F.lit(1)).alias("n_keys"))


def range_invariant(df: DataFrame, col: str, n: int) -> DataFrame:
    """One row: whether the value ranges of the partitions after a range
    repartition are ordered and disjoint, and the row count."""
    from pyspark.sql import Window

    p = tag_partition(by_range(df.select(col), n, col))
    b = p.groupBy(PID).agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(F.lit(1)).alias("c"))
    # the window runs over one row per partition
    prev_hi = F.lag("hi").over(Window.orderBy(PID))
    chk = b.select((prev_hi.isNull() | (prev_hi < F.col("lo"))).alias("okp"), "c")
    return chk.agg(F.min(F.col("okp").cast("int")).cast("boolean").alias("ok"), F.sum("c").alias("n_rows"))


def balance_invariant(df: DataFrame, n: int) -> DataFrame:
    """One row: whether round-robin partitions are balanced. Each input
    partition deals its rows round robin from its own start position, so
    sizes differ by at most the number of input partitions."""
    n_in = tag_partition(df).agg(F.max(PID) + 1).scalar()
    p = tag_partition(rebalance(df, n))
    b = p.groupBy(PID).agg(F.count(F.lit(1)).alias("c"))
    g = b.agg((F.max("c") - F.min("c")).alias("gap"), F.sum("c").alias("n_rows"))
    return g.select((F.col("gap") <= n_in).alias("ok"), "n_rows")
