"""A partitioned log as a stream source (a Python data source): the segments of
every partition are Parquet files in `<path>/partition=<p>/`, rows in the order
of their offsets. A query starts at the earliest or latest offsets, at offsets
given by partition, at a time, or where a named group has committed; it takes a
bounded number of rows from every partition in a micro-batch, goes on from its
checkpoint, and finds partitions that appear later."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from rivulet import storage

FORMAT = "rivulet_log"


@dataclass
class Segment(InputPartition):
    file: str
    partition: int
    first: int
    end: int  # the offset after the last one wanted

    def __post_init__(self):
        super().__init__(None)


class _Reader(DataSourceStreamReader):
    """Offsets are {partition: next offset to read}."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, options
        self.path = options["path"].rstrip("/")
        self.limit = int(options.get("maxOffsetsPerTrigger", 0))
        self.known: dict[str, tuple] = {}  # file: (partition, first, last, earliest time, latest time)
        self.at: dict | None = None  # where the batches planned so far end

    def _segments(self) -> list[tuple]:
        """(file, partition, first, last, times) of all segments; a file's footer is read
        once by a query."""
        import pyarrow.parquet as pq
        from pyarrow import fs as A

        fs, base = storage.in_task(self.path)
        for info in fs.get_file_info(A.FileSelector(base, recursive=True, allow_not_found=True)):
            if info.path in self.known or not info.path.endswith(".parquet") or "/_" in info.path[len(base):]:
                continue
            with fs.open_input_file(info.path) as f:
                meta = pq.ParquetFile(f).metadata
                names = [meta.schema.column(i).path for i in range(meta.num_columns)]
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                groups = [g for g in groups if g.num_rows]
                if not groups:
                    continue
                off = [g.column(names.index("offset")).statistics for g in groups]
                time = [g.column(names.index("ts")).statistics for g in groups]
                part = int(info.path.split("partition=")[1].split("/")[0])
                times = [s.max for s in time if s is not None and s.has_min_max]
                self.known[info.path] = (part, min(s.min for s in off), max(s.max for s in off), max(times, default=None))
        return sorted((v[0], v[1], v[2], v[3], k) for k, v in self.known.items())

    def _ends(self) -> dict:
        out: dict = {}
        for part, _, last, _, _ in self._segments():
            out[str(part)] = max(out.get(str(part), 0), last + 1)
        return out

    def _committed(self) -> dict:
        from pyarrow import fs as A

        if "group" not in self.options:
            return {}
        fs, file = _group_file(self.options["groupPath"], self.options["group"])
        if fs.get_file_info(file).type == A.FileType.NotFound:
            return {}
        with fs.open_input_stream(file) as f:
            return json.loads(f.read().decode())

    def initialOffset(self) -> dict:
        mode = self.options.get("startingPosition", "group" if "group" in self.options else "latest")
        ends = self._ends()
        reset = dict(ends) if self.options.get("reset", "latest") == "latest" else {}
        if mode == "earliest":
            start = {}
        elif mode == "latest":
            start = ends
        elif mode == "timestamp":
            start = self._at_time(datetime.fromisoformat(self.options["startingTimestamp"]))
        elif mode == "offsets":
            start = {**reset, **json.loads(self.options["startingOffsets"])}
        elif mode == "group":
            start = {**reset, **self._committed()}
        else:
            raise ValueError(f"unknown starting position {mode}")
        # a partition that has none is read from its beginning, also one that appears later
        return {str(p): int(o) for p, o in start.items()}

    def _at_time(self, time: datetime) -> dict:
        """Per partition the first offset whose time is not before `time`, the
        end where all are. Only the first segment that reaches the time is read."""
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        fs, _ = storage.in_task(self.path)
        out, ends = {}, self._ends()
        for part, _, _, latest, file in self._segments():
            if str(part) in out or latest is None or latest < time:
                continue
            with fs.open_input_file(file) as f:
                t = pq.read_table(f, columns=["offset", "ts"])
            hit = t.filter(pc.greater_equal(t["ts"], time))
            if hit.num_rows:
                out[str(part)] = pc.min(hit["offset"]).as_py()
        return {**ends, **out}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self.initialOffset()
        ends = self._ends()
        if self.limit:
            firsts: dict = {}
            for part, first, _, _, _ in self._segments():
                firsts.setdefault(str(part), first)
            ends = {p: min(e, max(self.at.get(p, 0), firsts[p]) + self.limit) for p, e in ends.items()}
        # a start beyond the end of a partition waits there
        self.at = {p: max(ends.get(p, 0), self.at.get(p, 0)) for p in sorted({*ends, *self.at})}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        self.at = self.at or end  # after a restart Spark plans the last batch of its checkpoint
        out = []
        for part, first, last, _, file in self._segments():
            lo, hi = max(start.get(str(part), 0), first), min(end.get(str(part), 0), last + 1)
            if lo < hi:
                out.append(Segment(file, part, lo, hi))
        return out

    def read(self, partition: Segment) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        fs, _ = storage.in_task(self.path)
        names = self.schema.names
        with fs.open_input_file(partition.file) as f:
            src = pq.ParquetFile(f)
            for batch in src.iter_batches(8192, columns=[n for n in names if n != "partition"]):
                off = batch.column(batch.schema.get_field_index("offset"))
                batch = batch.filter(pc.and_(pc.greater_equal(off, partition.first), pc.less(off, partition.end)))
                if batch.num_rows:
                    cols = [pa.array([partition.partition] * batch.num_rows, pa.int32()) if n == "partition"
                            else batch.column(batch.schema.get_field_index(n)) for n in names]
                    yield pa.RecordBatch.from_arrays(cols, names)

    def commit(self, end: dict) -> None:
        """Spark calls this for a batch when it begins the next one."""
        if "group" in self.options:
            _put_offsets(self.options["groupPath"], self.options["group"], end)


def _group_file(group_path: str, group: str):
    fs, base = storage.in_task(group_path)
    return fs, f"{base.rstrip('/')}/{group}.json"


def _put_offsets(group_path: str, group: str, offsets: dict) -> None:
    """Write a group's offsets: whole, in place of the earlier ones."""
    fs, file = _group_file(group_path, group)
    fs.create_dir(file.rsplit("/", 1)[0], recursive=True)
    tmp = f"{file}.{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as out:
        out.write(json.dumps(offsets).encode())
    fs.move(tmp, file)


def commit_group(spark: SparkSession, checkpoint: str, group_path: str, group: str) -> dict | None:
    """Commit for a group what the query with this checkpoint has finished,
    its last batch included; to be called when the query has stopped, so that
    another one may go on without its checkpoint. None before the first batch."""
    done = [int(n) for n in storage.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return None
    offsets = json.loads(storage.read_text(spark, f"{checkpoint}/offsets/{max(done)}").splitlines()[-1])
    _put_offsets(group_path, group, offsets)
    return offsets


class LogSource(DataSource):
    """`readStream.format(FORMAT).schema(…).load(path)` with the options of
    `log_stream`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> _Reader:
        return _Reader(schema, self.options)


def log_stream(spark: SparkSession, path: str, schema: StructType, starting: str | None = None, offsets: dict | None = None,
               timestamp: str | None = None, group: str | None = None, group_path: str | None = None,
               reset: str = "latest", max_offsets: int | None = None) -> DataFrame:
    """The log at `path` as a stream with the columns of `schema` (partition
    int, offset bigint, ts and more). `starting` is earliest, latest, offsets
    (from `offsets`, {partition: offset}), timestamp, or group: where `group`
    has committed below `group_path`. Partitions without an offset follow
    `reset`. At most `max_offsets` offsets of a partition make a micro-batch."""
    spark.dataSource.register(LogSource)
    r = spark.readStream.format(FORMAT).schema(schema).option("path", path).option("reset", reset)
    for key, value in (("startingPosition", starting), ("startingOffsets", json.dumps(offsets) if offsets else None),
                       ("startingTimestamp", timestamp), ("group", group), ("groupPath", group_path),
                       ("maxOffsetsPerTrigger", max_offsets)):
        if value is not None:
            r = r.option(key, str(value))
    return r.load()


def append_segments(log: DataFrame, path: str, rows_per_segment: int = 1_000_000) -> None:
    """Append rows (partition, offset, ts, …) to the log at `path`: every
    partition's rows in the order of their offsets, in segments of at most
    `rows_per_segment` rows. The ranges of a large partition are written by several tasks."""
    n = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    log.repartitionByRange(n, "partition", "offset").sortWithinPartitions("partition", "offset").write.mode("append").option(
        "maxRecordsPerFile", rows_per_segment).partitionBy("partition").parquet(path)
