"""JDBC sinks: append, upsert (`REPLACE INTO` semantics) and exactly-once
micro-batch writes.

Executors write rows in parallel (`DataFrame.write.jdbc`) into a staging
table; the driver then applies the staged rows to the target in one
transaction (delete matching keys + insert), together with a ledger row for
the micro-batch id, so a replayed batch is skipped. Only statements — never
rows — pass through the driver."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

LEDGER = "RIVULET_BATCH_LEDGER"


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None,
                num_partitions: int | None = None, batch_size: int = 1000) -> None:
    """Batch insert with typed parameters, `num_partitions` connections."""
    w = df if num_partitions is None else df.repartition(num_partitions)
    w.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties or {})


def _connection(spark: SparkSession, url: str, properties: dict | None):
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    return jvm.java.sql.DriverManager.getConnection(url, props)


def execute(spark: SparkSession, url: str, statements: Sequence[str], properties: dict | None = None,
            ignore_errors: bool = False) -> None:
    """Run DDL/DML statements from the driver in one transaction."""
    conn = _connection(spark, url, properties)
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        for s in statements:
            try:
                st.execute(s)
            except Exception:  # noqa: BLE001
                if not ignore_errors:
                    raise
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def query_rows(spark: SparkSession, url: str, sql: str, properties: dict | None = None) -> DataFrame:
    """Read a query result as a DataFrame."""
    return spark.read.format("jdbc").option("url", url).option("query", sql) \
        .options(**(properties or {})).load()


def jdbc_upsert(df: DataFrame, url: str, table: str, keys: Sequence[str],
                properties: dict | None = None, batch_id: int | None = None,
                job: str = "default") -> bool:
    """Upsert `df` into `table` by `keys` (last write wins). With `batch_id`
    the write is exactly-once: the ledger row (job, batch_id) is inserted
    in the same transaction, and a batch already in the ledger is skipped.
    Returns False when the batch was skipped."""
    spark = df.sparkSession
    keys = list(keys)
    if batch_id is not None:
        execute(spark, url, [f"CREATE TABLE {LEDGER} (job VARCHAR(200) NOT NULL, batch_id BIGINT NOT NULL, "
                             f"PRIMARY KEY (job, batch_id))"], properties, ignore_errors=True)
        seen = query_rows(spark, url, f"SELECT COUNT(*) AS n FROM {LEDGER} WHERE job = '{job}' "
                                      f"AND batch_id = {int(batch_id)}", properties).first()[0]
        if seen:
            return False
    stage = f"STG_{uuid.uuid4().hex[:16].upper()}"
    cols = ", ".join(df.columns)
    # staging table with the target's column types
    try:
        execute(spark, url, [f"CREATE TABLE {stage} AS SELECT {cols} FROM {table} WITH NO DATA"], properties)
    except Exception:  # noqa: BLE001 - dialects without WITH NO DATA
        execute(spark, url, [f"CREATE TABLE {stage} AS SELECT {cols} FROM {table} WHERE 1 = 0"], properties)
    df.write.jdbc(url, stage, mode="append", properties=properties or {})
    match = " AND ".join(f"{table}.{k} = s.{k}" for k in keys)
    stmts = [f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {match})",
             f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {stage}"]
    if batch_id is not None:
        stmts.append(f"INSERT INTO {LEDGER} (job, batch_id) VALUES ('{job}', {int(batch_id)})")
    try:
        execute(spark, url, stmts, properties)
    finally:
        execute(spark, url, [f"DROP TABLE {stage}"], properties, ignore_errors=True)
    return True


def upsert_each_batch(url: str, table: str, keys: Sequence[str], properties: dict | None = None,
                      job: str = "default"):
    """A `foreachBatch` function applying each micro-batch as an
    exactly-once upsert (the streaming JDBC / two-phase-commit sink)."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        jdbc_upsert(batch_df, url, table, keys, properties, batch_id=batch_id, job=job)

    return write


def append_each_batch(url: str, table: str, properties: dict | None = None):
    """A `foreachBatch` function inserting each micro-batch (the per-record
    stream JDBC sink, batched): rows go from executors straight to the
    database. At-least-once; use `upsert_each_batch` for exactly-once."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        jdbc_append(batch_df, url, table, properties)

    return write
