"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import written

HOT_SHARE = 1000


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let rows of whole texts travel to Python workers in batches of `rows`
    instead of Spark's default 10 000, which for texts are buffers of tens of MB
    in every task. Set on the session by the queries and the pipeline, unless
    the session has a setting of its own."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, str(rows))


def shared(spark: SparkSession, data, make):
    """A function that gives tasks the object make(data). Only `data`, plain
    values, is broadcast, since classes of a package that executors have not
    installed cannot be read from a broadcast; `make` travels with the task's
    function. The tasks of a Python worker share one object."""
    sent = spark.sparkContext.broadcast({"data": data})

    def get():
        held = sent.value
        if "made" not in held:
            held["made"] = make(held["data"])
        return held["made"]

    return get


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lookup(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], rows: int,
           count: str = "n_rows") -> DataFrame:
    """`left` with `values` of the row of `right` that has the same `keys`
    (null where there is none). `left` must be deterministic: it is read twice.

    `right` holds one row per key, with the number of rows it stands for in
    `count`; these numbers add up to at most `rows`. Keys of more than a
    thousandth of `rows` (and more than HOT_SHARE rows) are at most HOT_SHARE by
    that definition: their rows are broadcast, and the left rows they match are
    not shuffled at all. All others meet in a shuffle join, where no task
    receives a hot group."""
    limit = max(rows // HOT_SHARE, HOT_SHARE)
    right = written(right.select(*keys, *values, count), "lookup")  # read three times
    hot = right.where(F.col(count) > limit).select(*keys, *values)
    cold = right.where(F.col(count) <= limit).select(*[F.col(k).alias(f"__cold_{k}") for k in keys], *values)
    names = [*left.columns, *values]
    warm = left.join(F.broadcast(hot), keys).select(names)
    rest = left.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    on = [F.col(k) == F.col(f"__cold_{k}") for k in keys]
    return warm.union(rest.join(cold, on, "left").select(names))


def null_safe(c: Column) -> Column:
    """A string form of a column that keeps null apart from every value."""
    return F.concat(F.when(c.isNull(), F.lit("n")).otherwise(F.lit("v")), F.coalesce(c.cast("string"), F.lit("")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of `edges` (a long, b long; any direction):
    (id, component), component the smallest id that can be reached, for every
    id that has an edge.

    Large-star and small-star steps alternate until the edges no longer
    change; every step is written to the shared folder, which cuts lineage.
    Each edge row moves on its own, so a node with very many neighbours is
    only a key of a partial aggregation and of a `lookup`."""
    e = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = written(e, name)
    state = _state(e)
    while state[0]:
        big = written(_star(e.union(e.select("v", "u")), larger=True), name)
        e = written(_star(big, larger=False), name)
        now = _state(e)
        if now == state:
            break
        state = now
    ends = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return ends.union(roots)


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _star(e: DataFrame, larger: bool) -> DataFrame:
    """One star step over directed edges (u, v). Large star: every neighbour
    greater than u is linked to u's smallest neighbour (or u itself). Small
    star: u and its smaller neighbours are linked to the smallest of them."""
    low = e.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n_rows"))
    rows = e.count()
    j = lookup(e, low, ["u"], ["m"], rows)
    if larger:
        out = j.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def id_filter(ids: DataFrame, column: str, bits: int = 23) -> bytes:
    """A bitmap of 2^bits bits with bit xxhash64(id) mod 2^bits set for each
    id: a filter of fixed size (1 MB by default) with false positives only."""
    h = F.pmod(F.xxhash64(column), F.lit(1 << bits))
    words = ids.select(h.alias("h")).groupBy(F.shiftright("h", 5).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(pmod(h, 32) as int)))").alias("b"))
    import numpy as np

    rows = words.toPandas()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).astype(np.uint32)
    return out.tobytes()


def id_slot(column: str, bits: int = 23) -> Column:
    """The bit of `id_filter` that belongs to an id."""
    return F.pmod(F.xxhash64(column), F.lit(1 << bits))
