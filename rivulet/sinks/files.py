"""File sinks: text, delimited, and time-bucketed directory layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Bucket formats of the reference's row-file sinks.
HOUR_BUCKET = "yyyy-MM-dd--HH"
DAY_BUCKET = "yyyyMMdd"


def write_text(df: DataFrame, path: str, col: str | Column | None = None, mode: str = "overwrite",
               compression: str | None = None) -> None:
    """`writeAsText`: one line per row (a directory of part files)."""
    c = F.col(col) if isinstance(col, str) else col
    if c is None:
        c = F.concat_ws(",", *[F.col(x).cast("string") for x in df.columns])
    df.select(c.alias("value")).write.mode(mode).text(path, compression=compression)


def write_delimited(df: DataFrame, path: str, sep: str = "$", line_sep: str = "\n",
                    mode: str = "overwrite", header: bool = False) -> None:
    """`writeAsCsv(path, rowDelimiter, fieldDelimiter)`."""
    df.write.mode(mode).csv(path, sep=sep, lineSep=line_sep, header=header)


def bucket_column(ts: str | Column, fmt: str = DAY_BUCKET, name: str = "dt") -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, fmt).alias(name)


def write_bucketed(df: DataFrame, path: str, ts: str, fmt: str = DAY_BUCKET, bucket: str = "dt",
                   mode: str = "append", fmt_out: str = "parquet",
                   max_records_per_file: int | None = None) -> None:
    """Bucketing sink: rows go to `path/<bucket>=<value>/` by a time format
    of the record's own timestamp. A `rebalance` hint clusters rows by
    bucket so each task writes few files, and lets AQE split a bucket that
    holds a large share of the rows over several tasks (and merge small
    ones) instead of sending a whole hot day to one writer."""
    out = df.withColumn(bucket, bucket_column(ts, fmt, bucket)).hint("rebalance", bucket)
    w = out.write.mode(mode).partitionBy(bucket).format(fmt_out)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def read_bucketed(spark, path: str, bucket: str = "dt", fmt_in: str = "parquet") -> DataFrame:
    """Read a bucketed directory back; the bucket is read as the text it is
    (`03` stays `03`), not with an inferred type."""
    reader = spark.read.format(fmt_in).option("basePath", path)
    fields = [f if f.name != bucket else StructField(bucket, StringType()) for f in reader.load(path).schema]
    return reader.schema(StructType(fields)).load(path)
