"""Batch sources: literal collections, sequences, text / CSV / JSON files
(plain, gzip, recursive directories) with explicit schemas, and JDBC."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def from_elements(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """`fromElements` / `fromCollection`: a small literal dataset."""
    return spark.createDataFrame(list(rows), schema)


def sequence(spark: SparkSession, start: int, end: int, num_partitions: int | None = None,
             col: str = "id") -> DataFrame:
    """`generateSequence(from, to)`, both ends inclusive, generated in
    parallel."""
    df = spark.range(start, end + 1, 1, num_partitions)
    return df if col == "id" else df.withColumnRenamed("id", col)


def read_text(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """`readTextFile`: one row (`value`) per line; `.gz` files are
    decompressed by extension; `recursive` walks nested directories."""
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.text(path)


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",",
                   header: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """`readCsvFile(path).fieldDelimiter(sep).pojoType(fields…)`: typed
    columns in field order; a malformed row fails the read (FAILFAST), or
    use mode="PERMISSIVE" to get nulls."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header, mode=mode)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with an explicit schema (field names spelled as in the
    data)."""
    return spark.read.schema(schema).json(path)


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """JDBC source. With `table` + `partition_column` + bounds the read is
    split into `num_partitions` range queries that run in parallel; a
    free-form `query` is read by one task."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        return r.option("query", query).load()
    r = r.option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()
