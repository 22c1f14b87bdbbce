"""Console sinks: print a bounded number of rows with an output prefix
(`print` / `printToErr` with a sink identifier), for batch and streams."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame


def print_rows(df: DataFrame, n: int, prefix: str | None = None, to_err: bool = False) -> list[str]:
    """Print at most `n` rows as `prefix> row` lines (only `n` rows reach
    the driver). Returns the printed lines."""
    out = sys.stderr if to_err else sys.stdout
    lines = [f"{prefix}> {tuple(r)}" if prefix else str(tuple(r)) for r in df.take(n)]
    for line in lines:
        print(line, file=out)
    return lines
