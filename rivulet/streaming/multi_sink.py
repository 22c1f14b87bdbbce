"""One stream into several outputs in one pass: every micro-batch is written
once, its rows dealt to sub-folders by their tag, and one manifest
publishes all outputs of the batch together. A replayed batch finds its manifest and
leaves everything as it is."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import storage

TAG = "__tag"


def tag_by(rules: Mapping[str, Column], main: str = "main") -> Column:
    """The tag of a row: the first rule that holds (null does not), else `main`."""
    out = F.lit(main)
    for name, rule in reversed(list(rules.items())):
        out = F.when(rule, F.lit(name)).otherwise(out)
    return out


def write_tagged(path: str, tag: Column):
    """A `foreachBatch` function that writes the rows of a micro-batch to the
    output of their `tag` (a string column) below `path`."""
    path = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, commit = batch.sparkSession, f"{path}/commits/{batch_id:012d}.json"
        if f"{batch_id:012d}.json" in storage.names(spark, f"{path}/commits"):
            return
        name = uuid.uuid4().hex
        batch.withColumn(TAG, tag).write.partitionBy(TAG).parquet(f"{path}/data/{name}")
        tags = [x.split("=", 1)[1] for x in storage.names(spark, f"{path}/data/{name}") if x.startswith(f"{TAG}=")]
        if not storage.put_json(spark, commit, {"folder": name, "tags": tags}):
            storage.remove(spark, f"{path}/data/{name}")

    return write


def read_tagged(spark: SparkSession, path: str, schema, tag: str) -> DataFrame:
    """The rows of one output in all published batches."""
    path, folders = path.rstrip("/"), []
    for n in storage.names(spark, f"{path}/commits"):
        if n.endswith(".json") and n[0] != ".":
            m = storage.read_json(spark, f"{path}/commits/{n}")
            folders += [f"{path}/data/{m['folder']}/{TAG}={tag}"] if tag in m["tags"] else []
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
