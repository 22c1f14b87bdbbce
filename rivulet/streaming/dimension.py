"""Shared small data on streams: a dimension that changes over time is
re-read for every micro-batch (a polled JDBC table or any batch source) and
joined to the batch; the latest version per key wins (broadcast state).

A row whose key has no dimension entry yet sees null, as with broadcast
state before the first update arrives."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(dim: DataFrame, keys: Sequence[str], version: str | None) -> DataFrame:
    """Last write wins per key (`version` orders the writes)."""
    if version is None:
        return dim
    vals = [c for c in dim.columns if c not in keys]
    g = dim.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col(version)).alias("_d"))
    return g.select(*keys, *[F.col(f"_d.{c}").alias(c) for c in vals])


def enrich_each_batch(load_dimension: Callable[[], DataFrame], keys: Sequence[str],
                      sink: Callable[[DataFrame, int], None], version: str | None = None):
    """A `foreachBatch` function: re-read the dimension (so updates made
    since the last trigger are seen), keep its latest version per key, left
    join it to the micro-batch and hand the result to `sink`."""

    def run(batch_df: DataFrame, batch_id: int) -> None:
        dim = latest_per_key(load_dimension(), keys, version)
        sink(batch_df.join(dim, list(keys), "left"), batch_id)

    return run


def stream_bucketed_files(stream: DataFrame, path: str, checkpoint: str, ts: str,
                          fmt: str = "yyyy-MM-dd--HH", bucket: str = "bucket",
                          max_records_per_file: int | None = None, available_now: bool = True):
    """Streaming row-file sink with time buckets taken from each record
    (`path/bucket=<formatted time>/`), exactly-once through the file sink's
    commit log. Files close at the end of each micro-batch;
    `max_records_per_file` caps their size."""
    out = stream.withColumn(bucket, F.date_format(F.col(ts), fmt))
    w = (out.writeStream.format("parquet").outputMode("append").partitionBy(bucket)
         .option("path", path).option("checkpointLocation", checkpoint))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
