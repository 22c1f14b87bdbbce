"""The Python operator surface: a table function for ProcessFunction-style
flatMaps and per-partition set-up for rich map functions. Both exchange
Arrow batches with the JVM; the work per row is a small helper."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def words_arrow_udtf(key: str, line: str):
    """A table function emitting the words of each line (`trim` + split on
    white-space runs; blank lines emit nothing): it receives whole Arrow record
    batches of (key, line) rows through a TABLE argument and emits (key, word)
    rows with Arrow compute kernels — no per-row Python."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.functions import arrow_udtf

    from rivulet.functions.text import TRIM_SET, WHITESPACE_RUN

    @arrow_udtf(returnType=f"{key} bigint, word string")
    class ArrowWords:
        def eval(self, batch: pa.RecordBatch):
            t = pc.utf8_trim(batch.column(line), characters=TRIM_SET)
            keep = pc.fill_null(pc.greater(pc.utf8_length(t), 0), False)
            t = pc.filter(t, keep)
            k = pc.filter(batch.column(key), keep)
            parts = pc.split_pattern_regex(t, WHITESPACE_RUN)
            yield pa.table({key: pc.take(k, pc.list_parent_indices(parts)),
                            "word": pc.list_flatten(parts)})

    return ArrowWords


def count_pattern(df: DataFrame, col: str, pattern: str, out: str, keep: Sequence[str] = ()) -> DataFrame:
    """Count regex matches per row (a built-in expression)."""
    from pyspark.sql import functions as F

    return df.select(*keep, F.coalesce(F.regexp_count(F.col(col), F.lit(pattern)), F.lit(0)).cast("bigint").alias(out))


def with_setup(df: DataFrame, col: str, out: str, setup, keep: Sequence[str] = ()) -> DataFrame:
    """A rich map function: `setup()` runs once per partition (its `open`)
    and returns a function from an Arrow array to an Arrow bigint array, which
    is then applied to whole batches of `col`."""
    def run(batches):
        import pyarrow as pa

        fn = setup()
        for b in batches:
            cols = [b.column(k) for k in keep] + [fn(b.column(col)).cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [*keep, out])

    types = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keep] + [f"`{out}` bigint"])
    return df.select(*dict.fromkeys([*keep, col])).mapInArrow(run, schema)
