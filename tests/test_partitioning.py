from pyspark.sql import functions as F

from rivulet.operators import partitioning as P
from rivulet.sinks import files as FS


def test_placements(spark):
    df = spark.range(0, 21).select(F.col("id").alias("k"))
    assert P.rescale(df.repartition(6), 2).rdd.getNumPartitions() == 2
    assert P.forward(df) is df
    sh = P.tag_partition(P.shuffle_random(df, 4))
    assert sh.count() == 21
    cust = P.tag_partition(P.by_custom(df, 2, F.col("k") % 2)).where(F.col("pid") != F.col("k") % 2)
    assert cust.count() == 0
    assert P.range_invariant(df, "k", 4).first()["ok"]
    assert P.hash_invariant(df, "k", 4).first()["ok"]
    assert P.balance_invariant(spark.range(0, 21, 1, 1), 4).first()["ok"]


def test_sort_within_partitions(spark):
    df = spark.range(0, 100).select(((F.col("id") * 37) % 100).alias("v")).repartition(3)
    parts = df.sortWithinPartitions(F.col("v").desc()).rdd.glom().collect()
    for p in parts:
        vals = [r[0] for r in p]
        assert vals == sorted(vals, reverse=True)


def test_write_text(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    FS.write_text(df, f"{tmp_dir}/t")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_dir}/t").collect()) == ["1,a", "2,b"]


def test_sorted_invariant_compares_across_blocks(spark, monkeypatch):
    def verdict(values):
        df = spark.createDataFrame([(v,) for v in values], "v long").coalesce(1)
        return tuple(P.sorted_invariant(df, "v").first())

    assert verdict([5, None, 7, 1, None]) == (True, 5) and verdict([]) == (True, 0)
    monkeypatch.setattr(P, "sort_partitions", lambda df, *order: df)
    assert verdict(range(5000, 0, -1)) == (True, 5000)
    # every block of 1024 rows is in order, the partition is not
    assert verdict([v for b in range(4) for v in range(b * 1024 + 1023, b * 1024 - 1, -1)]) == (False, 4096)
    assert verdict([3, None, 2]) == (False, 3)
