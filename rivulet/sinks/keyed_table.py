"""A keyed table on files, for upserts that touch little: rows lie in buckets by
the hash of their key, a bucket is a base and the deltas written since. An
upsert writes one delta for the buckets it touches and merges only those that
have gathered too many. A manifest per version names the folders in force; it
appears at once, together with the id of the batch it brings, so a replayed
batch changes nothing and readers see whole versions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rivulet import storage

BUCKET, SEQ = "__bucket", "__seq"


class KeyedTable:
    """The table at `path`. Keys may be null (a key like any other); the last
    upsert of a key wins, and of rows of one upsert with equal keys the
    greatest by `order` and then by the other columns in their order. `buckets` is
    fixed when the table is made: take about one for 100 MB of rows."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 8, max_deltas: int = 4,
                 order: str | None = None):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets, self.max_deltas, self.order = buckets, max_deltas, order

    def manifest(self, version: int | None = None) -> dict | None:
        """What a version (by default the last) is made of; None before the first."""
        if version is None:
            known = [int(n[:-5]) for n in storage.names(self.spark, f"{self.path}/versions") if n.endswith(".json") and n[0] != "."]
            if not known:
                return None
            version = max(known)
        return storage.read_json(self.spark, f"{self.path}/versions/{version:012d}.json")

    def upsert(self, rows: DataFrame, batch_id: int | None = None, job: str = "default") -> bool:
        """Make the next version; False if the job's batch is in the table
        already. One writer at a time: of two, the second fails."""
        last = self.manifest() or {"version": 0, "buckets": self.buckets, "keys": self.keys, "jobs": {}, "parts": {},
                                   "schema": rows.schema.json()}
        if batch_id is not None and last["jobs"].get(job, -1) >= batch_id:
            return False
        if last["keys"] != self.keys:
            raise ValueError(f"the table's keys are {last['keys']}")
        schema = StructType.fromJson(json.loads(last["schema"]))
        version, n = last["version"] + 1, last["buckets"]
        latest = self._latest(rows.select(schema.names), schema.names, [self.order] if self.order else [])
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int")
        delta = self._write(latest.withColumn(SEQ, F.lit(version).cast("long")).withColumn(BUCKET, bucket))
        parts = {b: list(x) for b, x in last["parts"].items()}
        for b, folder in delta.items():
            parts.setdefault(b, []).append(folder)
        full = [b for b in delta if len(parts[b]) > self.max_deltas + 1]
        if full:  # only touched buckets are merged
            merged = self._merged(schema, [f for b in full for f in parts[b]]).withColumn(BUCKET, bucket)
            for b, folder in self._write(merged).items():
                parts[b] = [folder]
        jobs = {**last["jobs"], **({job: batch_id} if batch_id is not None else {})}
        made = {**last, "version": version, "parts": parts, "jobs": jobs}
        if not storage.put_json(self.spark, f"{self.path}/versions/{version:012d}.json", made):
            raise RuntimeError(f"version {version} of {self.path} was written by another job")
        return True

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version. A bucket without deltas is only scanned."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        schema = StructType.fromJson(json.loads(m["schema"]))
        plain = [x[0] for x in m["parts"].values() if len(x) == 1]
        several = [f for x in m["parts"].values() if len(x) > 1 for f in x]
        out = [self._scan(schema, plain).select(schema.names)] if plain else []
        out += [self._merged(schema, several).select(schema.names)] if several else []
        return out[0].unionByName(out[1]) if len(out) == 2 else out[0] if out else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = 2) -> int:
        """Delete the folders and manifests that only versions before the last
        `keep` need; returns how many folders went."""
        last = self.manifest()
        if last is None:
            return 0
        kept = range(max(1, last["version"] - keep + 1), last["version"] + 1)
        used = {f.split("/")[0] for v in kept for x in self.manifest(v)["parts"].values() for f in x}
        gone = [f for f in storage.names(self.spark, f"{self.path}/data") if f not in used]
        for name in storage.names(self.spark, f"{self.path}/versions"):
            if name.endswith(".json") and name[0] != "." and int(name[:-5]) < kept[0]:
                storage.remove(self.spark, f"{self.path}/versions/{name}")
        for f in gone:
            storage.remove(self.spark, f"{self.path}/data/{f}")
        return len(gone)

    def _latest(self, rows: DataFrame, columns: list[str], first: list[str]) -> DataFrame:
        vals = [c for c in columns if c not in self.keys]
        if not vals:
            return rows.select(*self.keys).distinct()
        best = F.max(F.struct(*first, *[F.col(c) for c in vals if c not in first])).alias("__r")
        g = rows.groupBy(*self.keys).agg(best)  # combined before the shuffle, so a key with many rows is cheap
        return g.select(*self.keys, *[F.col("__r").getField(c).alias(c) for c in vals])

    def _merged(self, schema: StructType, folders: list[str]) -> DataFrame:
        return self._latest(self._scan(schema, folders), [*schema.names, SEQ], [SEQ])

    def _scan(self, schema: StructType, folders: list[str]) -> DataFrame:
        typed = StructType([*schema.fields, StructField(SEQ, LongType())])
        return self.spark.read.schema(typed).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Write rows as one folder; returns the sub-folder of each bucket."""
        name = uuid.uuid4().hex
        rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *self.keys).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{name}")
        made = [x for x in storage.names(self.spark, f"{self.path}/data/{name}") if x.startswith(f"{BUCKET}=")]
        return {x.split("=")[1]: f"{name}/{x}" for x in made}


def upsert_each_batch(table: KeyedTable, job: str = "default"):
    """A `foreachBatch` function that upserts every micro-batch exactly once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, job)

    return write
