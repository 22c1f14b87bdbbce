"""Keys of a stream dealt to buckets by a hash: one call of a stateful processor
and one state value serve all keys of a bucket, so that the calls of a
micro-batch do not grow with the keys it holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def dealt(rows: DataFrame, key_col: str, buckets: int, *columns: Column | str) -> DataFrame:
    """(bucket, key, keyed) and `columns` of `rows`. Keys arrive with a flag
    instead of nulls, so integers stay integers."""
    kind, key = dict(rows.dtypes)[key_col], F.col(key_col)
    return rows.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"),
                       (F.coalesce(key, F.lit(0).cast(kind)) if kind in _WHOLE else key).alias("key"),
                       key.isNotNull().alias("keyed"), *columns)


def numbered(known: list, keys, keyed) -> tuple:
    """The number of the key of every row, and the keys by their numbers: those
    `known` come first and keep theirs. The null key is None."""
    import numpy as np
    import pandas as pd

    keyed = np.asarray(keyed, bool)
    codes, found = pd.factorize(pd.Series(keys)[keyed])
    number = {k: i for i, k in enumerate(known)}
    of = [number.setdefault(k, len(number)) for k in found.tolist()]
    out = np.empty(len(keyed), np.int64)
    out[keyed] = np.asarray(of, np.int64)[codes]
    if not keyed.all():
        out[~keyed] = number.setdefault(None, len(number))
    return out, list(number)


def named(keys: list, codes):
    """The keys of these numbers, for a column of the output."""
    import numpy as np

    values = np.empty(len(keys), object)
    values[:] = keys
    return values[codes]
