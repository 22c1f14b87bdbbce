"""Running Structured Streaming queries over file sources and reading their
results back as batch DataFrames.

Sinks are exactly-once: the file sink commits through its `_spark_metadata`
log, and `foreachBatch` writes each micro-batch to its own `batch=<id>`
folder with overwrite, so a replayed batch replaces itself. Checkpoints and
outputs live below the shared checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet.session import ensure_utc, scratch_path
from rivulet.sinks.keyed_table import KeyedTable, upsert_each_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> None:
    """Session settings streaming operators rely on: UTC event time and
    the RocksDB state store (needed by transformWithState, and it keeps
    large state off the JVM heap)."""
    ensure_utc(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


#: Session setting: files a stream takes into one micro-batch (unset: all that have arrived).
FILES_PER_TRIGGER = "rivulet.stream.maxFilesPerTrigger"


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A table as a streaming source: a single Parquet file or a folder of
    part files, with the schema fixed up front. Files are taken in the order
    of their arrival, `max_files_per_trigger` at a time (by default the
    session's FILES_PER_TRIGGER); rows of later files that lie behind the
    watermark are late."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if schema is None:
        schema = spark.read.parquet(path).schema
    path = path[:-1] + "[t]"  # a pattern matches a file as well as a folder of this name
    r = spark.readStream.schema(schema)
    limit = max_files_per_trigger or spark.conf.get(FILES_PER_TRIGGER, None)
    return (r.option("maxFilesPerTrigger", limit) if limit else r).parquet(path)


#: Session setting: about as many rows make one micro-batch of `run_in_time_order`.
ROWS_PER_BATCH = "rivulet.stream.rowsPerBatch"


def run_in_time_order(rows: DataFrame, ts_col: str, build: Callable[[DataFrame], DataFrame], name: str,
                      min_batches: int = 1) -> DataFrame:
    """Run the append-mode query `build` over a table whose rows arrive in
    event-time order, about ROWS_PER_BATCH (by default 125 000 for each core) in
    a micro-batch, so that this bounds what one key has in a batch, and
    `min_batches` at least. Rows of the same millisecond stay in one batch: none
    is behind the watermark."""
    spark = rows.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    size = int(spark.conf.get(ROWS_PER_BATCH, str(125_000 * tasks)))
    n = max(min_batches, -(-rows.count() // size))
    time = F.date_trunc("millisecond", F.col(ts_col).cast("timestamp"))
    ranges = rows.repartitionByRange(max(n, 1) * tasks, time.asc_nulls_last())
    return run_slices(ranges.withColumn(SLICE, F.floor(F.spark_partition_id() / tasks).cast("int")), max(n, 1), build, name)


SLICE = "__slice"


def run_slices(rows: DataFrame, n: int, build: Callable[[DataFrame], DataFrame], name: str,
               run: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Run the append-mode query `build` with `run` (by default `run_append`)
    over rows that arrive in `n` slices (column SLICE, from 0). The rows are written once; the files of a slice
    are moved to the source folder, and the query runs to the end of what has
    arrived and stops before the next slice, which goes on from its checkpoint."""
    spark = rows.sparkSession
    staged, source, ck, out = (scratch_path(spark, f"{name}-{x}") for x in ("staged", "in", "ckpt", "out"))
    rows.write.partitionBy(SLICE).parquet(staged)
    like = rows.drop(SLICE)
    like.limit(0).coalesce(1).write.parquet(source)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    for i in range(n):
        arrived = path(f"{staged}/{SLICE}={i}")
        if fs.exists(arrived) and not fs.rename(arrived, path(f"{source}/slice-{i}")):
            raise RuntimeError(f"slice {i} of {staged} could not be moved to {source}")
        st = spark.readStream.schema(like.schema).option("recursiveFileLookup", "true").parquet(source)
        result = (run or run_append)(build(st), name, checkpoint=ck, path=out)
    return result


def event_time(df: DataFrame, col: str = "ts", out: str | None = None) -> DataFrame:
    """Watermarks need TIMESTAMP; the tables hold TIMESTAMP_NTZ (UTC)."""
    return df.withColumn(out or col, F.col(col).cast("timestamp"))


def run_append(stream: DataFrame, name: str, checkpoint: str | None = None,
               path: str | None = None, available_now: bool = True,
               processing_time: str | None = None) -> DataFrame:
    """Run an append-mode query into a Parquet file sink until the available
    input is processed; return the sink read back as a batch DataFrame."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    w = stream.writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", checkpoint).option("path", path)
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    else:  # periodic trigger: run until the current input is processed, then stop
        q = w.trigger(processingTime=processing_time or "5 seconds").start()
        q.processAllAvailable()
        q.stop()
    if q.exception():
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(path)


def run_update(stream: DataFrame, name: str, keys: Sequence[str], checkpoint: str | None = None,
               path: str | None = None) -> DataFrame:
    """Run an update-mode aggregation: every micro-batch's changed rows are
    upserted by `keys` into the keyed table at `path`, once for each batch
    id; returns the table's rows."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    table = KeyedTable(spark, path, keys)
    q = (stream.writeStream.outputMode("update").foreachBatch(upsert_each_batch(table, name))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return table.read() if table.manifest() else spark.createDataFrame([], stream.schema)
