from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from conftest import rows
from rivulet.operators.scan import Running, global_seq, keyed_scan


def _skewed(spark, n=3000):
    # one key holds a third of the rows, the rest are spread over 50 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"),
        ((F.col("id") * 7919) % 1000).alias("t"), F.col("id").alias("i"),
        (((F.col("id") * 104729) % 97) / 4.0).alias("v"))


def test_keyed_scan_matches_window_on_hot_key(spark):
    df = _skewed(spark)
    specs = [Running(None, "count", "c"), Running("v", "sum", "s"), Running("v", "max", "m"),
             Running("v", "max", "mp", inclusive=False), Running("i", "last", "lp", inclusive=False)]
    got = keyed_scan(df, ["k"], ["t", "i"], specs, ranges=13)
    w = Window.partitionBy("k").orderBy("t", "i")
    exp = df.select("i", F.count("*").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mp"),
                    F.lag("i").over(w).alias("lp"))
    assert rows(got, "i", "c", "s", "m", "mp", "lp") == rows(exp)


def test_global_seq_dense_and_ordered(spark):
    df = _skewed(spark)
    got = global_seq(df, ["t", "i"], "n", ranges=7)
    exp = df.select("i", F.row_number().over(Window.orderBy("t", "i")).alias("n"))
    assert rows(got, "i", "n") == rows(exp)


def test_decimal_sum_exact(spark):
    df = spark.createDataFrame([(1, i, f"{i}.01") for i in range(100)], "k int, i int, v string") \
        .withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = keyed_scan(df, ["k"], ["i"], [Running("v", "sum", "s")], ranges=4)
    last = got.where("i = 99").first()["s"]
    assert str(last) == "4951.00"


def test_keyed_scan_property(spark):
    """Random tables (few keys, heavy duplication of one key, random
    partition counts) against a pandas reference."""
    import pandas as pd
    from hypothesis import given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.integers(0, 50), st.integers(-5, 5))

    @settings(max_examples=8, deadline=None)
    @given(st.lists(row, min_size=1, max_size=60), st.integers(1, 9))
    def check(data, parts):
        pdf = pd.DataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(data)], columns=["k", "t", "i", "v"])
        df = spark.createDataFrame(pdf)
        got = keyed_scan(df, ["k"], ["t", "i"], [Running("v", "sum", "s"), Running(None, "count", "c"),
                                                  Running("v", "max", "mp", inclusive=False)],
                         ranges=parts)
        exp = pdf.sort_values(["k", "t", "i"]).copy()
        g = exp.groupby("k")
        exp["s"] = g["v"].cumsum()
        exp["c"] = g.cumcount() + 1
        exp["mp"] = g["v"].transform(lambda x: x.cummax().shift(1))
        want = sorted((int(r.i), int(r.s), int(r.c), None if pd.isna(r.mp) else float(r.mp))
                      for r in exp.itertuples())
        have = sorted((r["i"], r["s"], r["c"], r["mp"]) for r in got.collect())
        assert have == want

    check()


def test_session_scan_property(spark):
    """Sessions from the one-pass scan equal a sequential reference for
    random gaps, hot keys and partition counts (sessions spanning many
    partitions included)."""
    import pandas as pd
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from rivulet.operators.scan import session_scan

    row = st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.integers(0, 200))

    @settings(max_examples=8, deadline=None)
    @given(st.lists(row, min_size=1, max_size=80), st.integers(1, 12), st.integers(0, 30))
    def check(data, parts, gap):
        pdf = pd.DataFrame([(k, t, i) for i, (k, t) in enumerate(data)], columns=["k", "t", "i"])
        got = session_scan(spark.createDataFrame(pdf), ["k"], "t", "i", gap, "s", ranges=parts)
        want = {}
        for k, g in pdf.sort_values(["k", "t", "i"]).groupby("k"):
            prev, start = None, None
            for r in g.itertuples():
                if prev is None or r.t - prev > gap:
                    start = r.t
                want[r.i] = start
                prev = r.t
        assert {r["i"]: r["s"] for r in got.collect()} == want

    check()


AWKWARD_SQL_TYPES = "k long, t long, i long, v long, d double, b long"


@pytest.mark.parametrize("ranges", [2, 5, 40])
def test_nulls_and_exact_types_match_windows(spark, ranges):
    """Null keys and values, trailing nulls, bigints above 2^53 and a hot key
    over many ranges, against Spark's own windows."""
    big = 1 << 60
    data = []
    for n in range(600):
        k = None if n % 5 == 0 else 0 if n % 3 else n % 7
        data.append((k, (n * 37) % 100, n, None if n % 4 == 0 or n > 560 else n % 11,
                     None if n % 6 else n / 8, None if n % 9 == 0 else big + n))
    df = spark.createDataFrame(data, AWKWARD_SQL_TYPES).repartition(7)
    specs = [Running("v", "sum", "s"), Running("v", "max", "m"), Running("d", "max", "md"), Running("b", "max", "mb"),
             Running("b", "last", "lb"), Running("b", "last", "lx", inclusive=False), Running(None, "count", "c"), Running(None, "count", "cx", inclusive=False)]
    for keys in (["k"], []):
        got = keyed_scan(df, keys, ["t", "i"], specs, ranges=ranges)
        w = Window.partitionBy(*keys).orderBy("t", "i")
        inc, exc = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
        exp = df.select("*", F.sum("v").over(inc).alias("s"), F.max("v").over(inc).alias("m"), F.max("d").over(inc).alias("md"),
                        F.max("b").over(inc).alias("mb"), F.last("b", True).over(inc).alias("lb"),
                        F.last("b", True).over(exc).alias("lx"),
                        F.count("*").over(inc).alias("c"), F.count("*").over(exc).alias("cx"))
        cols = ["i", "s", "m", "md", "mb", "lb", "lx", "c", "cx"]
        assert dict(got.dtypes)["mb"] == "bigint" and dict(got.dtypes)["md"] == "double"
        assert {r["i"]: tuple(r) for r in got.select(*cols).collect()} == {r["i"]: tuple(r) for r in exp.select(*cols).collect()}


def test_session_of_null_key_is_one(spark):
    from rivulet.operators.scan import session_scan

    df = spark.createDataFrame([(None, i * 10, i) for i in range(300)], "k long, t long, i long")
    assert session_scan(df, ["k"], "t", "i", 10, "s", ranges=9).select("s").distinct().count() == 1


def test_empty_and_tiny_tables(spark):
    df = spark.createDataFrame([], "k long, i long, v long")
    assert keyed_scan(df, ["k"], ["i"], [Running("v", "sum", "s")]).collect() == []
    assert global_seq(spark.createDataFrame([(5,)], "i long"), ["i"]).collect()[0]["seq"] == 1


def test_large_keys_stay_split_over_ranges(spark):
    from rivulet.operators.scan import with_ranges

    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    sizes = [r["count"] for r in with_ranges(df, ["k", "i"], 8).groupBy("_scan_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 4
