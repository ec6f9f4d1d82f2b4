"""Event-time watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import TimestampNTZType, TimestampType


def with_watermark(df: DataFrame, column: str, delay: str) -> DataFrame:
    """``withWatermark(column, delay)`` with an early type check.

    The watermark is (max event time seen) - delay, advanced between
    micro-batches. A row whose window ends at or before the watermark of the
    batch before last is dropped; a window is emitted (append) and evicted
    from state once its end is at or before the current watermark.
    """
    dt = df.schema[column].dataType
    if isinstance(dt, TimestampNTZType):
        raise TypeError(f"{column} is TIMESTAMP_NTZ; cast it to TIMESTAMP before a watermark")
    if not isinstance(dt, TimestampType):
        raise TypeError(f"{column} must be TIMESTAMP, got {dt.simpleString()}")
    return df.withWatermark(column, delay)
