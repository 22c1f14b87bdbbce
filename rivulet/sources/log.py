"""Partitioned log tables (the shape of a Kafka topic: partition, offset,
timestamp, value) and start positions on them. A start position is
earliest, latest, explicit per-partition offsets, or a timestamp; as with a
consumer, the last call wins. Applying it is a filter plus a join with one
row per log partition."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StartPosition:
    mode: str = "group"            # earliest | latest | offsets | timestamp | group
    offsets: tuple = ()            # ((partition, offset), ...) for mode=offsets / group
    timestamp: str | None = None   # for mode=timestamp

    # builder methods mirror a consumer's setStartFrom* calls: the last wins
    def from_earliest(self) -> "StartPosition":
        return StartPosition("earliest")

    def from_latest(self) -> "StartPosition":
        return StartPosition("latest")

    def from_offsets(self, offsets: Mapping[int, int]) -> "StartPosition":
        return StartPosition("offsets", tuple(sorted(offsets.items())))

    def from_timestamp(self, ts: str) -> "StartPosition":
        return StartPosition("timestamp", timestamp=ts)

    def from_group_offsets(self, committed: Mapping[int, int]) -> "StartPosition":
        return StartPosition("group", tuple(sorted(committed.items())))

    def kafka_options(self, topic: str) -> dict[str, str]:
        """The equivalent `readStream.format("kafka")` options for `topic`. A
        group position without committed offsets has no option: the consumer
        group's own offsets hold."""
        import json

        if self.mode == "earliest":
            return {"startingOffsets": "earliest"}
        if self.mode == "latest":
            return {"startingOffsets": "latest"}
        if self.mode == "timestamp":
            from datetime import datetime, timezone

            ms = int(datetime.fromisoformat(self.timestamp).replace(tzinfo=timezone.utc).timestamp() * 1000)
            return {"startingTimestamp": str(ms)}
        if not self.offsets:
            return {}
        return {"startingOffsets": json.dumps({topic: {str(p): o for p, o in self.offsets}})}


def start_from(log: DataFrame, pos: StartPosition, partition: str = "partition",
               offset: str = "offset", ts: str = "ts", default: str = "latest") -> DataFrame:
    """Rows of `log` a consumer starting at `pos` would read. Partitions
    without an explicit offset follow `default` (the reset policy)."""
    spark = log.sparkSession
    # the explicit offsets are a literal list, so their join is broadcast
    if pos.mode == "earliest":
        return log
    if pos.mode == "latest":
        return log.limit(0)
    if pos.mode == "timestamp":
        # per partition, the first offset whose timestamp is >= ts
        first = log.where(F.col(ts) >= F.lit(pos.timestamp).cast(log.schema[ts].dataType)) \
                   .groupBy(partition).agg(F.min(offset).alias("_start"))
        return log.join(first, partition).where(F.col(offset) >= F.col("_start")).drop("_start")
    starts = spark.createDataFrame(list(pos.offsets), f"{partition} {log.schema[partition].dataType.simpleString()}, _start bigint")
    if default == "earliest":
        j = log.join(F.broadcast(starts), partition, "left")
        return j.where(F.col("_start").isNull() | (F.col(offset) >= F.col("_start"))).drop("_start")
    return log.join(F.broadcast(starts), partition).where(F.col(offset) >= F.col("_start")).drop("_start")


def events_as_log(events: DataFrame, partitions: int = 3) -> DataFrame:
    """The events table viewed as a log: partition = user_id % n, offset =
    event_id (increasing within a partition), ts, value = JSON payload."""
    return events.select((F.col("user_id") % partitions).cast("int").alias("partition"),
                         F.col("event_id").alias("offset"), "ts",
                         F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"))
