"""A transactional file sink for streams and batches, as a Python data source.

Tasks stage Parquet files that nobody reads; their commit messages name the
files and carry what they counted. The driver publishes one manifest for each
batch id, which appears at once: a batch that fails leaves staged files only, a
task that is tried again leaves one message, and a replayed batch finds its
manifest and is dropped. Readers read the files of manifests."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from rivulet import storage

FORMAT = "rivulet_transactional"


@dataclass
class Staged(WriterCommitMessage):
    file: str | None
    rows: int
    counts: dict = field(default_factory=dict)


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str, count_by: str | None):
        self.path, self.count_by = path.rstrip("/"), count_by

    def write(self, iterator: Iterator) -> Staged:
        """Stage the rows of a task as one file; without rows there is none."""
        import pyarrow.parquet as pq

        fs, base = storage.in_task(self.path)
        name, out, rows, counts = f"{uuid.uuid4().hex}.parquet", None, 0, {}
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(f"{base}/data", recursive=True)
                stream = fs.open_output_stream(f"{base}/data/{name}")
                out = pq.ParquetWriter(stream, batch.schema)
            out.write_batch(batch)
            rows += batch.num_rows
            if self.count_by:
                for v in batch.column(self.count_by).value_counts().to_pylist():
                    key = json.dumps(v["values"], default=str)
                    counts[key] = counts.get(key, 0) + v["counts"]
        if out is None:
            return Staged(None, 0)
        out.close()
        stream.close()
        return Staged(name, rows, counts)

    def commit(self, messages: list, batchId: int) -> None:
        done = [m for m in messages if m is not None]
        counts: dict = {}
        for m in done:
            for k, n in m.counts.items():
                counts[k] = counts.get(k, 0) + n
        manifest = {"batch": batchId, "files": [m.file for m in done if m.file], "rows": sum(m.rows for m in done), "counts": counts}
        if not self._publish(f"{batchId:012d}.json", manifest):
            self._discard(done)  # the batch is there already: this is a replay

    def abort(self, messages: list, batchId: int) -> None:
        self._discard([m for m in messages if m is not None])

    def _publish(self, name: str, manifest: dict) -> bool:
        """The manifest under its name, whole, unless the name is taken. Only
        the one driver of the query publishes."""
        from pyarrow import fs as F

        fs, base = storage.in_task(self.path)
        fs.create_dir(f"{base}/commits", recursive=True)
        if fs.get_file_info(f"{base}/commits/{name}").type != F.FileType.NotFound:
            return False
        tmp = f"{base}/commits/.{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(tmp) as out:
            out.write(json.dumps(manifest).encode())
        fs.move(tmp, f"{base}/commits/{name}")
        return True

    def _discard(self, messages: list) -> None:
        fs, base = storage.in_task(self.path)
        for m in messages:
            if m.file:
                fs.delete_file(f"{base}/data/{m.file}")


class TransactionalSink(DataSource):
    """`writeStream.format(FORMAT).option("path", …)`; the option `countBy` names
    a column whose values are counted, exactly, in the manifests."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options.get("countBy"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TransactionalSink)


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """The manifests of all published batches, in their order."""
    path = path.rstrip("/")
    found = [n for n in storage.names(spark, f"{path}/commits") if n.endswith(".json") and n[0] != "."]
    return [storage.read_json(spark, f"{path}/commits/{n}") for n in found]


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all published batches."""
    files = [f"{path.rstrip('/')}/data/{f}" for m in manifests(spark, path) for f in m["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def committed_counts(spark: SparkSession, path: str) -> dict:
    """How often each value of the counted column was written: every task
    that counts is counted once, whatever was tried again."""
    total: dict = {}
    for m in manifests(spark, path):
        for k, n in m["counts"].items():
            total[json.loads(k)] = total.get(json.loads(k), 0) + n
    return total


def remove_unpublished(spark: SparkSession, path: str) -> int:
    """Delete staged files that no manifest names, those of tasks and
    drivers that were lost. To be called while no query writes."""
    path, used = path.rstrip("/"), {f for m in manifests(spark, path) for f in m["files"]}
    gone = [n for n in storage.names(spark, f"{path}/data") if n not in used]
    for n in gone:
        storage.remove(spark, f"{path}/data/{n}")
    return len(gone)
