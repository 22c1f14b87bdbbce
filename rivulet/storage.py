"""Small files of the driver (manifests, offsets) on any file system Spark knows,
and the file system of a path for Python code in tasks."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none where it does not exist."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str):
    return json.loads(read_text(spark, path))


def put_json(spark: SparkSession, path: str, value) -> bool:
    """Write `value` under a name that is not taken yet: the whole file
    appears at once. False (and nothing changes) if the name is taken."""
    fs, p = _at(spark, path)
    jvm = spark._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(tmp), fs.makeQualified(p), no_overwrite)
        return True
    except Exception:  # noqa: BLE001 - the name is taken, or a real failure
        fs.delete(tmp, False)
        if fs.exists(p):
            return False
        raise


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def in_task(path: str):
    """(file system, path in it) of a path, for tasks: local, HDFS or an
    object store that Arrow knows."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")
