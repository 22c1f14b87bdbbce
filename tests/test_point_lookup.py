"""The lookup index against a dictionary, and the blocks it reads."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from rivulet import storage
from rivulet.operators import point_lookup as P


def _index(spark, path, n=3000):
    rows = spark.range(n).select((F.col("id") * 3).alias("k"), F.concat(F.lit("name "), "id").alias("name"),
                                 F.when(F.col("id") % 5 > 0, F.col("id") / 2).alias("v"))
    nobody = spark.createDataFrame([(None, "nobody", 1.0)], "k long, name string, v double")
    P.write_index(rows.unionByName(nobody), "k", path, files=4, block_bytes=2048)
    return storage.read_json(spark, f"{path}/index.json")


def test_lookups_equal_a_dictionary(spark, tmp_dir):
    path = f"{tmp_dir}/index"
    _index(spark, path)
    rng = random.Random(1)
    asked = [(i, rng.choice([None, -1, 9, 10 ** 9, rng.randint(-5, 9100)])) for i in range(700)]
    facts = spark.createDataFrame(asked, "id long, who long").withColumn("k", F.lit("clash")).repartition(3)
    got = {r.id: (r.name, r.v, r.lookup_status) for r in P.indexed_lookup(facts, path, "who", ["name", "v"]).collect()}
    for i, k in asked:
        here = k is not None and k % 3 == 0 and 0 <= k < 9000
        n = k // 3 if here else None
        assert got[i] == ((f"name {n}", n / 2 if n % 5 else None, "hit") if here else (None, None, "miss")), (k, got[i])
    assert P.indexed_lookup(facts.limit(0), path, "who", ["name"]).collect() == []
    P.write_index(spark.createDataFrame([], "k long, name string"), "k", f"{tmp_dir}/empty")
    assert {r.lookup_status for r in P.indexed_lookup(facts, f"{tmp_dir}/empty", "who", ["name"]).collect()} == {"miss"}


def test_only_needed_blocks_are_read_and_kept(spark, tmp_dir):
    path = f"{tmp_dir}/index"
    index = _index(spark, path, 30_000)
    blocks = P._Blocks(path, "k", index["files"], ["k", "name"], 4, None, 3)
    everything = sum(len(blocks._footer(f)) for f, _, _ in index["files"])
    assert everything > 8
    rows, late = blocks.find(np.array([3, 6, 9]))
    assert rows.num_rows == 3 and not len(late) and blocks.n_read == 1
    blocks.find(np.array([12, 15]))
    assert blocks.n_read == 1  # kept
    blocks.find(np.arange(0, 90_000, 3))
    assert blocks.n_read == everything and len(blocks.held) == 3
    assert blocks.find(np.array([-7, 4, 10 ** 12]))[0].num_rows == 0


def test_late_blocks_are_timeouts(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/index"
    index = _index(spark, path)
    blocks = P._Blocks(path, "k", index["files"], ["k", "name"], 1, 0.05, 3)
    monkeypatch.setattr(blocks, "_read", lambda block: time.sleep(0.5))
    rows, late = blocks.find(np.array([0, 8997]))
    assert rows is None and late.tolist() == [0, 8997]
