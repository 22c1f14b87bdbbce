"""Point lookups in a large keyed table from inside tasks, without a shuffle of
either side: the table is written once in the order of its key, as files of
small blocks. A task looks keys up in batches: it finds the files by their
bounds, the blocks by the statistics of a file's footer, reads the blocks that
may hold a wanted key, several at a time, and keeps the last ones it has read."""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructType

from rivulet import storage

HIT, MISS, TIMEOUT = "hit", "miss", "timeout"


def write_index(table: DataFrame, key: str, path: str, files: int | None = None, block_bytes: int = 1 << 20) -> None:
    """Write `table` below `path` in the order of `key`, a whole number, one
    row per key (rows with a null key are left out, they are never found).
    `files` is by default the number of shuffle partitions."""
    spark, path = table.sparkSession, path.rstrip("/")
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = table.where(F.col(key).isNotNull()).repartitionByRange(n, key).sortWithinPartitions(key)
    rows.write.option("parquet.block.size", block_bytes).option("parquet.page.row.count.limit", 1000).parquet(f"{path}/rows")
    back = spark.read.schema(table.schema).parquet(f"{path}/rows")
    bounds = back.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    found = [[r.file, r.lo, r.hi] for r in bounds.orderBy("lo").collect()]  # one row per file
    storage.put_json(spark, f"{path}/index.json", {"key": key, "schema": table.schema.json(), "files": found})


class _Blocks:
    """The blocks of an index as a task sees them."""

    def __init__(self, path: str, key: str, files: list, columns: list[str], in_flight: int, timeout: float | None, keep: int):
        self.path, self.key, self.files, self.columns = path, key, files, columns
        self.pool, self.timeout, self.keep = ThreadPoolExecutor(in_flight), timeout, keep
        self.footers: dict = {}
        self.held: OrderedDict = OrderedDict()  # the blocks read last
        self.n_read = 0

    def _footer(self, file: str):
        if file not in self.footers:
            import pyarrow.parquet as pq

            fs, base = storage.in_task(self.path)
            with fs.open_input_file(f"{base}/rows/{file}") as f:
                meta = pq.ParquetFile(f).metadata
            at = [meta.schema.column(i).path for i in range(meta.num_columns)].index(self.key)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            self.footers[file] = [(s.min, s.max) for s in stats]
        return self.footers[file]

    def _wanted(self, keys) -> dict:
        """(file, block): the sorted keys that it may hold."""
        import numpy as np

        out, his = {}, np.array([hi for _, _, hi in self.files], dtype=np.int64)
        lows = np.array([lo for _, lo, _ in self.files], dtype=np.int64)
        at = np.searchsorted(his, keys)
        inside = at < len(his)
        inside[inside] = lows[at[inside]] <= keys[inside]
        for f in np.unique(at[inside]).tolist():
            mine = keys[inside & (at == f)]
            for g, (lo, hi) in enumerate(self._footer(self.files[f][0])):
                a, b = np.searchsorted(mine, [lo, hi + 1])
                if a < b:
                    out[self.files[f][0], g] = mine[a:b]
        return out

    def _read(self, block: tuple):
        import pyarrow.parquet as pq

        fs, base = storage.in_task(self.path)
        with fs.open_input_file(f"{base}/rows/{block[0]}") as f:
            return pq.ParquetFile(f).read_row_group(block[1], columns=self.columns)

    def find(self, keys):
        """(table of the rows found, keys whose block did not come in time)."""
        import numpy as np
        import pyarrow as pa

        wanted, late, found = self._wanted(keys), [], []
        asked = {b: self.pool.submit(self._read, b) for b in wanted if b not in self.held}
        self.n_read += len(asked)
        wait(asked.values(), timeout=self.timeout)
        for b, mine in wanted.items():
            if b in asked:
                if not asked[b].done():
                    asked[b].cancel()
                    late.append(mine)
                    continue
                self.held[b] = asked[b].result()
            self.held.move_to_end(b)
            rows = self.held[b]
            k = rows.column(self.key).to_numpy()
            at = np.searchsorted(k, mine)
            at = at[(at < len(k)) & (k[np.minimum(at, len(k) - 1)] == mine)]
            found.append(rows.take(pa.array(at)))
        while len(self.held) > self.keep:
            self.held.popitem(last=False)
        return (pa.concat_tables(found) if found else None), (np.concatenate(late) if late else np.zeros(0, np.int64))


def indexed_lookup(facts: DataFrame, path: str, on: str, values: Sequence[str], status: str = "lookup_status",
                   in_flight: int = 8, timeout: float | None = None, keep_blocks: int = 64) -> DataFrame:
    """`facts` with `values` of the indexed row whose key is the column `on`, and
    `status`: hit, miss (no such key, or a null one; the values are null) or
    timeout (the block did not come within `timeout` seconds of its batch being
    asked for; null too). A task has at most `in_flight` reads on the way and
    holds at most `keep_blocks` blocks besides those of the batch at hand."""
    spark: SparkSession = facts.sparkSession
    index = storage.read_json(spark, f"{path.rstrip('/')}/index.json")
    held, key, files, values = StructType.fromJson(json.loads(index["schema"])), index["key"], index["files"], list(values)
    schema = StructType([*facts.schema.fields, *[held[v] for v in values]]).add(status, StringType())
    types = {v: to_arrow_type(held[v].dataType) for v in values}
    where = path.rstrip("/")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        blocks = _Blocks(where, key, files, list(dict.fromkeys([key, *values])), in_flight, timeout, keep_blocks)
        for b in batches:
            asked = b.column(b.schema.get_field_index(on)).cast(pa.int64())
            keys = np.unique(asked.drop_null().to_numpy(zero_copy_only=False))
            rows, late = blocks.find(keys)
            if rows is None:
                place = pa.array([None] * b.num_rows, pa.int64())
                cols = [pa.nulls(b.num_rows, types[v]) for v in values]
            else:
                place = pc.index_in(asked, value_set=rows.column(key).combine_chunks().cast(pa.int64()), skip_nulls=True)
                cols = [rows.column(v).combine_chunks().take(place) for v in values]
            state = pc.if_else(place.is_valid(), HIT, pc.if_else(pc.fill_null(pc.is_in(asked, value_set=pa.array(late, pa.int64())), False), TIMEOUT, MISS))
            yield pa.RecordBatch.from_arrays([*b.columns, *cols, state], schema.names)

    return facts.mapInArrow(run, schema)
