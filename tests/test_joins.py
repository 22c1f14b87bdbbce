from pyspark.sql import functions as F

from conftest import rows
from rivulet.operators import joins as J
from rivulet.operators.rangejoin import bucketed_range_join

U = J.UNKNOWN


def _stock_shelf(spark):
    stock = spark.createDataFrame([(10, "bolts"), (20, "nuts"), (30, "washers")], "id int, item string")
    shelf = spark.createDataFrame([(20, "B2"), (30, "C1"), (40, "D9")], "id int, place string")
    return stock, shelf


def test_left_right_full_fill(spark):
    stock, shelf = _stock_shelf(spark)
    assert rows(J.outer_join(stock, shelf, "id", "left", fill=["place"])) == \
        [(10, "bolts", U), (20, "nuts", "B2"), (30, "washers", "C1")]
    assert rows(J.outer_join(stock, shelf, "id", "right", fill=["item"])) == \
        [(20, "nuts", "B2"), (30, "washers", "C1"), (40, U, "D9")]
    assert rows(J.outer_join(stock, shelf, "id", "full", fill=["item", "place"])) == \
        [(10, "bolts", U), (20, "nuts", "B2"), (30, "washers", "C1"), (40, U, "D9")]


def test_lookup_misses_give_null(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c"), (None, "d")], "k int, x string")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    got = J.lookup_join(facts, dim, "k")
    assert rows(got.where("k IS NOT NULL")) == [(1, "a", "one"), (2, "b", "two"), (9, "c", None)]
    assert got.where("k IS NULL").first()["name"] is None
    # whether to broadcast is the optimizer's choice, by bytes: no hint in the plan
    assert "hint" not in got._jdf.queryExecution().logical().toString().lower()


def test_range_join_matches_brute_force(spark):
    segs = spark.createDataFrame([(0, 99, "a"), (100, 100, "b"), (101, 5000, "c"), (7000, 9000, "d")],
                                 "seg_start long, seg_end long, name string")
    pts = spark.range(0, 9500, 7).select(F.col("id").alias("v"))
    got = bucketed_range_join(pts, segs, "v", bits=6).select("v", "name")
    brute = pts.join(segs, (pts.v >= segs.seg_start) & (pts.v <= segs.seg_end), "left").select("v", "name")
    assert rows(got) == rows(brute)


def test_point_lookup_timeout_and_miss(spark):
    import time

    def lookup(k):
        if k == 3:
            time.sleep(3)
        return {1: "u1", 2: "u2", 3: "slow"}.get(k)

    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (1,), (None,)], "k long")
    # one slot: the hung call gives it back, so the keys after it are answered
    got = J.point_lookup_enrich(df, "k", lookup, "name", timeout_s=0.5, max_in_flight=1)
    assert rows(got.where("k IS NOT NULL")) == [(1, "u1"), (1, "u1"), (2, "u2"), (3, "unknown"), (4, U)]
    assert got.where("k IS NULL").first()["name"] == U


PARTS = [(1, "frame", 4, 12.5), (2, "wheel", 9, 30.25), (3, "chain", 4, 7.75), (4, "bell", 2, 3.0), (5, "pump", 9, 11.5)]
MAKERS = [(2, "Ost"), (4, "West"), (9, "Nord")]


def test_delimited_files_join(spark, tmp_dir):
    from rivulet.sources.basic import read_delimited

    for name, table in (("parts", PARTS), ("makers", MAKERS)):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.writelines(",".join(map(str, r)) + "\n" for r in table)
    parts = read_delimited(spark, f"{tmp_dir}/parts.csv", "id INT, part STRING, maker INT, price DOUBLE")
    makers = read_delimited(spark, f"{tmp_dir}/makers.csv", "id INT, name STRING")
    j = parts.join(makers, parts.maker == makers.id).select("part", "name", "price")
    assert dict(j.groupBy("name").agg(F.sum("price")).collect()) == {"Ost": 3.0, "West": 20.25, "Nord": 41.75}


def test_cached_file_lookup(spark, tmp_dir):
    """A dimension from memory and one from a shipped CSV file give
    the same rows; a malformed line fails the read."""
    import pytest

    parts = spark.createDataFrame(PARTS, "id int, part string, maker int, price double")
    makers = spark.createDataFrame(MAKERS, "maker int, name string")
    with open(f"{tmp_dir}/makers.csv", "w") as f:
        f.writelines(",".join(map(str, r)) + "\n" for r in MAKERS)
    cached = J.read_lookup_file(spark, f"{tmp_dir}/makers.csv", "maker INT, name STRING")
    got = J.lookup_join(parts, makers, "maker")
    assert rows(J.lookup_join(parts, cached, "maker"), "id", "name") == rows(got, "id", "name")
    with open(f"{tmp_dir}/bad.csv", "w") as f:
        f.write("x,West\n")
    with pytest.raises(Exception):
        J.read_lookup_file(spark, f"{tmp_dir}/bad.csv", "maker INT, name STRING").collect()
