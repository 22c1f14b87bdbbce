"""Date/time helpers for epoch-millisecond and formatted timestamps.

All timestamps in the benchmark tables are TIMESTAMP_NTZ; these helpers
treat them as UTC wall-clock time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.cols import as_col

# The three date keys of the click-log roll-up.
ROLLUP_FORMATS = ("yyyy-MM-dd-HH", "yyyy-MM-dd", "yyyy-MM")


def epoch_ms(c) -> Column:
    """TIMESTAMP(_NTZ) → epoch milliseconds (UTC)."""
    return F.unix_millis(as_col(c).cast("timestamp"))


def from_epoch_ms(c) -> Column:
    """epoch milliseconds → TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_millis(as_col(c)).cast("timestamp_ntz")


def rollup_keys(c, formats=ROLLUP_FORMATS) -> Column:
    """One timestamp → array of its hour, day and month keys (flatMap B3)."""
    return F.array(*[F.date_format(as_col(c), f) for f in formats])


def parse_ts(c, fmt: str) -> Column:
    """Formatted string → TIMESTAMP_NTZ; null when it does not parse."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("timestamp_ntz")


def parse_ts_or_now(c, fmt: str) -> Column:
    """Formatted string → timestamp, falling back to the query's current
    time when parsing fails (the daily report's rule)."""
    return F.coalesce(parse_ts(c, fmt), F.current_timestamp().cast("timestamp_ntz"))
