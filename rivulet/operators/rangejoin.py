"""Range lookup join: each point finds the segment [start, end] containing
it (IP → region). Written as an equi-join on a coarse bucket of the value
plus a range filter, so Spark plans a hash join instead of a nested loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucketed_range_join(points: DataFrame, segments: DataFrame, value_col: str,
                        start_col: str = "seg_start", end_col: str = "seg_end",
                        bits: int = 16, how: str = "left") -> DataFrame:
    """Join `points.value_col` to the segment with start <= value <= end.

    A segment is listed once per bucket (`value >> bits`) it touches, so a
    point only meets the segments of its own bucket. Choose `bits` so the
    exploded segment table stays near the segment count: the width of a
    bucket should be about the width of a typical segment. Segments must not
    overlap (one match per point); `how="left"` keeps unmatched points."""
    b = "_rj_bucket"
    seg = segments.withColumn(
        b, F.explode(F.sequence(F.shiftright(F.col(start_col), bits),
                                F.shiftright(F.col(end_col), bits))))
    pts = points.withColumn(b, F.shiftright(F.col(value_col), bits))
    cond = ((pts[b] == seg[b]) & (pts[value_col] >= seg[start_col]) & (pts[value_col] <= seg[end_col]))
    return pts.join(seg, cond, how).drop(b)
