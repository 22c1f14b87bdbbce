"""Dyadic blocks and the narrowest-range lookup against brute force."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.operators.prefix_ranges import dyadic_blocks, narrowest_range_join


def test_blocks_cover_their_range_once(spark):
    pairs = [(a, b) for a in range(16) for b in range(16)] + [(0, 31), (31, 31), (17, 16)]
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select("a", "b", dyadic_blocks(F.col("a"), F.col("b"), 5).alias("blocks")).collect():
        held = [x for b in r.blocks for x in range(b.prefix << (5 - b.level), (b.prefix + 1) << (5 - b.level))]
        assert sorted(held) == list(range(r.a, r.b + 1)) and len(r.blocks) <= 10
    null = df.select(dyadic_blocks(F.lit(None).cast("long"), F.col("b"), 5).alias("x")).first().x
    assert not null


def brute(values, ranges):
    out = {}
    for i, v in values:
        held = [(b - a, -a, tuple("" if x is None else x for x in rest), rest) for a, b, *rest in ranges
                if v is not None and a is not None and b is not None and a <= v <= b and 0 <= v < 2 ** 32]
        best = min(held, key=lambda h: (h[0], h[1]), default=None)
        if best:
            out[i] = max((h for h in held if h[:2] == best[:2]), key=lambda h: h[2])[3]
        else:
            out[i] = [None]
    return out


def check(spark, values, ranges):
    f = spark.createDataFrame(values, "id long, v long").withColumn("name0", F.lit(1))
    r = spark.createDataFrame(ranges, "seg_start long, seg_end long, name string")
    got = {x.id: [x.name] for x in narrowest_range_join(f, r, "v", "id").collect()}
    assert got == brute(values, ranges)


def test_overlapping_ranges_of_any_width(spark):
    rng = random.Random(7)
    top = 2 ** 32 - 1
    ranges = [(0, top, "all"), (0, 2 ** 31, "half"), (5, 4, "empty"), (None, 9, "null"), (9, None, "null"), (top, top, "last"), (3, 3, None)]
    for i in range(60):
        a = rng.randint(0, top)
        ranges.append((a, min(top, a + rng.choice([0, 1, 255, 70_000, 2 ** 29])), f"r{i}"))
    ranges += [ranges[-1], (*ranges[-1][:2], "tie")]
    values = [(i, rng.choice([rng.randint(0, top), rng.choice([r[0] for r in ranges]), rng.choice([r[1] for r in ranges])])) for i in range(400)]
    values += [(1000, None), (1001, -5), (1002, 2 ** 40), (1003, 3), (1004, 0), (1005, top)]
    check(spark, values, ranges)
    check(spark, values[:5], ranges[2:3])
    check(spark, [], ranges)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 30), st.sampled_from("abc")), max_size=8),
       st.lists(st.integers(0, 95), max_size=12))
def test_small_cases(spark, spans, values):
    check(spark, list(enumerate(values)), [(a, a + w, n) for a, w, n in spans])
