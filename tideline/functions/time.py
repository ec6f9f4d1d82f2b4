"""Event-time conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_event_time(
    df: DataFrame, column: str = "timestamp", precision: str = "seconds"
) -> DataFrame:
    """Replace an epoch-seconds DOUBLE column by a TIMESTAMP.

    ``precision="seconds"`` keeps the semantics of
    ``from_unixtime(x).cast("timestamp")``: the double is cast to BIGINT first,
    so fractions are dropped (toward zero). It is computed without the
    session-zone string round trip. ``"micros"`` keeps the fraction.
    """
    c = F.col(column)
    if precision == "seconds":
        ts = F.timestamp_seconds(c.try_cast("long"))
    elif precision == "micros":
        ts = F.timestamp_micros(F.round(c * F.lit(1_000_000)).try_cast("long"))
    else:
        raise ValueError(f"precision must be 'seconds' or 'micros', got {precision!r}")
    return df.withColumn(column, ts)
