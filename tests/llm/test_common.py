from pyspark.sql import functions as F

from rivulet.llm.common import lookup


def test_lookup_spreads_hot_keys(spark):
    """A key with most of the rows is answered by the broadcast side and
    its rows stay out of the shuffle join."""
    left = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    left = left.unionByName(spark.createDataFrame([(None, -1), (-5, -2)], "k long, id long"))
    right = left.where("k IS NOT NULL AND k <> -5").groupBy("k").agg(F.count("*").alias("n_rows"), F.min("id").alias("low"))
    want = {r.k: r.low for r in right.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup(left, right, ["k"], ["low"], left.count())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    rows = got.collect()
    assert len(rows) == left.count()
    assert all(r.low == want.get(r.k) for r in rows)
    assert max(sizes) < 20_000  # of 60 002 rows, 40 000 have the hot key
