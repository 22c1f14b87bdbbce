import gzip
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rivulet.sinks import files as FS
from rivulet.sinks import jdbc as JD
from rivulet.sources import basic as SB
from rivulet.sources.log import StartPosition, start_from

# These start a database inside the test's JVM, so they run only when asked for.
needs_database = pytest.mark.skipif(not os.environ.get("RIVULET_TEST_DERBY"), reason="RIVULET_TEST_DERBY is not set")
DERBY = "jdbc:derby:memory:rivulet_{};create=true"
DERBY_PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_text_gzip_and_recursive(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/a/b")
    with open(f"{tmp_dir}/a/1.txt", "w") as f:
        f.write("x y\nz\n")
    with gzip.open(f"{tmp_dir}/a/b/2.txt.gz", "wt") as f:
        f.write("w\n")
    assert sorted(r[0] for r in SB.read_text(spark, f"{tmp_dir}/a", recursive=True).collect()) == ["w", "x y", "z"]
    assert SB.read_text(spark, f"{tmp_dir}/a/b/2.txt.gz").count() == 1


def test_delimited_read_and_dollar_sink(spark, tmp_dir):
    with open(f"{tmp_dir}/score.csv", "w") as f:
        f.write("1,zs,1,98\n2,zs,2,77.5\n")
    df = SB.read_delimited(spark, f"{tmp_dir}/score.csv", "id INT, stuName STRING, subId INT, score DOUBLE")
    assert rows(df) == [(1, "zs", 1, 98.0), (2, "zs", 2, 77.5)]
    FS.write_delimited(df, f"{tmp_dir}/out", sep="$")
    back = SB.read_delimited(spark, f"{tmp_dir}/out", "id INT, stuName STRING, subId INT, score DOUBLE", sep="$")
    assert rows(back) == rows(df)
    with open(f"{tmp_dir}/u.data", "w") as f:
        f.write("196\t242\t3\t881250949\n")
    tab = SB.read_delimited(spark, f"{tmp_dir}/u.data", "userId INT, movieId INT, rating DOUBLE, ts BIGINT", sep="\t")
    assert tab.first()["movieId"] == 242


def test_sequence_and_elements(spark):
    assert SB.sequence(spark, 1, 30, 3).count() == 30
    assert SB.from_elements(spark, [("a", 1)], "k string, v int").first()["v"] == 1


def test_bucketed_sink(spark, tmp_dir):
    import datetime as dt

    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 6))],
                               "id long, ts timestamp_ntz")
    FS.write_bucketed(df, f"{tmp_dir}/b", "ts")
    assert sorted(os.listdir(f"{tmp_dir}/b"))[-2:] == ["dt=20240101", "dt=20240102"]
    assert rows(FS.read_bucketed(spark, f"{tmp_dir}/b").select("id", "dt")) == [(1, "20240101"), (2, "20240102")]
    FS.write_bucketed(df.select("id", "ts"), f"{tmp_dir}/day", "ts", fmt="dd")
    assert rows(FS.read_bucketed(spark, f"{tmp_dir}/day").select("id", "dt")) == [(1, "01"), (2, "02")]


def test_log_start_positions(spark):
    import datetime as dt

    log = spark.createDataFrame([(p, o, dt.datetime(2024, 1, 1, 0, o)) for p in range(2) for o in range(5)],
                                "partition int, offset long, ts timestamp_ntz")
    pos = StartPosition().from_latest().from_offsets({0: 3})
    assert rows(start_from(log, pos), "partition", "offset") == [(0, 3), (0, 4)]
    assert rows(start_from(log, pos, default="earliest"), "partition", "offset") == \
        [(0, 3), (0, 4)] + [(1, o) for o in range(5)]
    assert start_from(log, StartPosition().from_timestamp("2024-01-01 00:03:00")).count() == 4
    assert start_from(log, StartPosition().from_latest()).count() == 0
    assert pos.kafka_options("orders") == {"startingOffsets": '{"orders": {"0": 3}}'}
    assert StartPosition().kafka_options("orders") == {}
    assert StartPosition().from_group_offsets({1: 7}).kafka_options("t") == {"startingOffsets": '{"t": {"1": 7}}'}


@needs_database
def test_jdbc_append_read_upsert_exactly_once(spark):
    url = DERBY.format("t1")
    JD.execute(spark, url, ["CREATE TABLE t_student (id INT PRIMARY KEY, name VARCHAR(50), age INT)"], DERBY_PROPS)
    df = spark.createDataFrame([(1, "a", 20), (2, "b", 21)], "ID int, NAME string, AGE int")
    JD.jdbc_append(df, url, "t_student", DERBY_PROPS)
    got = SB.read_jdbc(spark, url, table="t_student", properties=DERBY_PROPS, partition_column="ID",
                       lower=1, upper=3, num_partitions=2)
    assert rows(got) == [(1, "a", 20), (2, "b", 21)]
    upd = spark.createDataFrame([(2, "B", 31), (3, "c", 22)], "ID int, NAME string, AGE int")
    assert JD.jdbc_upsert(upd, url, "t_student", ["ID"], DERBY_PROPS, batch_id=7, job="j")
    # the same micro-batch again is skipped (exactly-once)
    assert not JD.jdbc_upsert(upd.withColumn("AGE", F.lit(99)), url, "t_student", ["ID"], DERBY_PROPS,
                              batch_id=7, job="j")
    q = JD.query_rows(spark, url, "SELECT ID, NAME, AGE FROM t_student", DERBY_PROPS)
    assert rows(q) == [(1, "a", 20), (2, "B", 31), (3, "c", 22)]


def test_print_rows_prefix(spark, capsys):
    from rivulet.sinks.console import print_rows

    lines = print_rows(spark.createDataFrame([(1,), (3,)], "v int"), 5, "odd")
    assert lines == ["odd> (1,)", "odd> (3,)"]
    assert "odd> (1,)" in capsys.readouterr().out
