"""Lookup of numbers in ranges of any width that may overlap and nest.

A range of whole numbers below 2^bits is the union of at most 2 * bits dyadic
blocks, a block being all numbers with the same leading bits. Ranges become
rows (level, prefix) and a number one row for each level that occurs, so the
lookup is an equi-join whatever the widths; nothing is copied by width."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dyadic_blocks(first: Column, last: Column, bits: int) -> Column:
    """The blocks of first..last as an array of (level, prefix): the numbers
    whose upper `level` bits are `prefix`. From both ends inwards, a level at a
    time: an odd left end or an even right end is a block of its own. Null or
    empty for a range without numbers."""
    block = "array<struct<level:int,prefix:bigint>>"
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def step(s, up):
        lo, hi = s["lo"], s["hi"]
        some = lo <= hi
        left, right = some & (lo.bitwiseAND(one) == 1), some & (hi.bitwiseAND(one) == 0)
        level = F.lit(bits) - up
        made = F.concat(
            F.when(left, F.array(F.struct(level.alias("level"), lo.alias("prefix")))).otherwise(F.array().cast(block)),
            F.when(right & ~(left & (lo == hi)), F.array(F.struct(level.alias("level"), hi.alias("prefix")))).otherwise(F.array().cast(block)))
        lo, hi = F.when(left, lo + one).otherwise(lo), F.when(right, hi - one).otherwise(hi)
        # the ends may have crossed; then nothing is left on the next levels
        return F.struct(F.when(lo <= hi, F.shiftright(lo, 1)).otherwise(one).alias("lo"),
                        F.when(lo <= hi, F.shiftright(hi, 1)).otherwise(zero).alias("hi"),
                        F.concat(s["blocks"], made).alias("blocks"))

    start = F.struct(first.cast("bigint").alias("lo"), last.cast("bigint").alias("hi"), F.array().cast(block).alias("blocks"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(bits)), start, step)["blocks"]


def narrowest_range_join(facts: DataFrame, ranges: DataFrame, value: str, row_id: str, bits: int = 32,
                         first: str = "seg_start", last: str = "seg_end") -> DataFrame:
    """`facts` with the columns of the narrowest range that holds `value`, both
    ends included (of equally wide ones that with the largest start, then the
    greatest by its columns); nulls where none does, the value is null
    or outside 0..2^bits - 1. `row_id` is unique among the facts."""
    given = [c for c in ranges.columns if c not in facts.columns]
    width = F.col(last).cast("bigint") - F.col(first).cast("bigint")
    r = ranges.where(F.col(first) <= F.col(last)).select(
        F.struct((-width).alias("narrow"), F.col(first).alias("start"), F.struct(*given).alias("row")).alias("seg"),
        F.inline(dyadic_blocks(F.col(first), F.col(last), bits)))
    # of equal blocks only the best range can win, so a number meets one range on a level
    r = r.groupBy("level", "prefix").agg(F.max("seg").alias("seg"))
    levels = r.agg(F.sort_array(F.collect_set("level"))).scalar()  # at most bits + 1 numbers
    v = F.col(value).cast("bigint")
    f = facts.where(v.between(0, (1 << bits) - 1)).select(row_id, v.alias("__v"), F.explode(levels).alias("level"))
    f = f.withColumn("prefix", F.expr(f"shiftright(__v, {bits} - level)"))
    best = f.join(r, ["level", "prefix"]).groupBy(row_id).agg(F.max("seg").alias("__seg"))
    out = facts.join(best, row_id, "left")
    return out.select(*facts.columns, *[F.col("__seg.row").getField(c).alias(c) for c in given])
