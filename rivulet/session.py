"""Session helpers: building a local session for tests/bench and finding the
shared checkpoint folder on a cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every rivulet job assumes. On a cluster they come from the job's
# submit configuration; `local_session` sets them for tests and the bench.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rivulet", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RIVULET_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    `spark.checkpoint.dir` is read from the session. Only in a local session
    (tests) without the setting is a private folder created and registered;
    elsewhere a missing setting is an error, since executors could not see
    a folder of the driver's own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        configured = local_folder(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_folder(master: str) -> str:
    """A private checkpoint folder, for a single-JVM session only."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master!r}")
    return tempfile.mkdtemp(prefix="rivulet-ckpt-")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/rivulet-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` once to a scratch table and return the table: its rows are
    frozen and lost executors cannot change them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete every scratch table this session has made. To be called when
    the results that read them are stored; returns how many were deleted."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def ensure_utc(spark: SparkSession) -> None:
    """Event-time operators interpret TIMESTAMP_NTZ columns as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
