from pyspark.sql import functions as F

from conftest import rows
from rivulet.operators import agg as A
from rivulet.operators.changelog import retract_changes, upsert_latest


def test_min_by_tie_rule(spark):
    df = spark.createDataFrame([("a", 1.0, 2, "x"), ("a", 1.0, 1, "y"), ("b", 3.0, 5, "z")],
                               "g string, p double, k int, name string")
    assert rows(A.min_by_row(df, ["g"], "p", ["k"], ["name"])) == [("a", 1.0, 1, "y"), ("b", 3.0, 5, "z")]


def test_incremental_aggregate_merges_partials(spark):
    import math

    import numpy as np

    df = spark.range(0, 1000, 1, 7).select((F.col("id") % 3).alias("k"), (F.col("id") / 100).cast("double").alias("v"))
    cents = df.select("k", (F.col("v").cast("decimal(18,2)") * 100).cast("bigint").alias("c"))
    got = A.incremental_aggregate(cents, ["k"], A.UnscaledSum("c"), ["c"], "s", "decimal(28,2)")
    exp = df.groupBy("k").agg(F.sum(F.col("v").cast("decimal(18,2)")).cast("decimal(28,2)").alias("s"))
    assert rows(got) == rows(exp)
    red = A.reduce_pairs(cents.where("c > 0").withColumn("c", F.col("c") * 6), ["k"], "c", np.gcd, "g", "bigint")
    assert rows(red) == [(k, math.gcd(*[6 * i for i in range(1, 1000) if i % 3 == k])) for k in range(3)]


def test_decimal_sum_rounds_half_up(spark):
    """0.125 + 0.125 + 0.375 is 0.64 in cents rounded half up."""
    df = spark.createDataFrame([(0.125,), (0.125,), (0.375,), (None,)], "v double")
    cents = df.select((F.col("v").cast("decimal(18,2)") * 100).cast("bigint").alias("c"))
    got = A.incremental_aggregate(cents, [], A.UnscaledSum("c"), ["c"], "s", "decimal(28,2)").first()["s"]
    assert str(got) == "0.64"
    huge = spark.createDataFrame([(1 << 62,)] * 9 + [(-(1 << 62),)], "c bigint").repartition(3)
    total = A.incremental_aggregate(huge, [], A.UnscaledSum("c", 0), ["c"], "s", "decimal(38,0)").first()["s"]
    assert int(total) == 8 << 62


def test_observe_count(spark):
    df, obs = A.observe_count(spark.range(123))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 123


def test_upsert_and_retract(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upd = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert rows(upsert_latest(base, upd, ["k"])) == [(1, "a"), (2, "B"), (3, "c")]
    old = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n long")
    new = spark.createDataFrame([("x", 1), ("y", 3), ("z", 1)], "k string, n long")
    assert rows(retract_changes(old, new, ["k"])) == [(False, "y", 2), (True, "y", 3), (True, "z", 1)]
    null_key = spark.createDataFrame([(None, 5), ("q", 1)], "k string, n long")
    assert retract_changes(null_key, null_key, ["k"]).collect() == []
    twice = spark.createDataFrame([(2, "x"), (2, "z"), (2, "y")], "k int, v string")
    assert rows(upsert_latest(base, twice, ["k"])) == [(1, "a"), (2, "z")]
    versions = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, v string, ver int")
    assert rows(upsert_latest(versions, versions.where("ver = 1"), ["k"], "ver")) == [(1, "new")]


def test_incremental_aggregate_global(spark):
    df = spark.range(0, 500, 1, 5).select((F.col("id") * 25).alias("v"))
    got = A.incremental_aggregate(df, [], A.UnscaledSum("v"), ["v"], "s", "decimal(28,2)").collect()
    assert len(got) == 1 and str(got[0]["s"]) == "31187.50"


def test_incremental_aggregate_passes_accumulators_on(spark, monkeypatch):
    """More keys in a partition than a task holds, a key in every batch, null keys."""
    monkeypatch.setattr(A, "KEYS_HELD", 50)
    df = spark.range(0, 4000, 1, 2).select(
        F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 4 < 3, F.col("id") % 900).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = rows(A.incremental_aggregate(df, ["k"], A.UnscaledSum("v", 0), ["v"], "s", "decimal(28,0)").where("k IS NOT NULL"))
        null = A.incremental_aggregate(df, ["k"], A.UnscaledSum("v", 0), ["v"], "s", "decimal(28,0)").where("k IS NULL").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    exp = df.groupBy("k").agg(F.sum("v").cast("decimal(28,0)").alias("s"))
    assert got == rows(exp.where("k IS NOT NULL"))
    assert [r.s for r in null] == [r.s for r in exp.where("k IS NULL").collect()]
