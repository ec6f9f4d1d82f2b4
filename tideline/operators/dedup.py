"""De-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    within_watermark: bool = False,
) -> DataFrame:
    """Keep one row per key.

    Batch (and inside ``foreachBatch``): with ``order_by`` the row with the
    smallest ordering tuple is kept, deterministically. It is a
    ``groupBy(keys).agg(min_by(row, order))``, so partial aggregation runs
    before the shuffle and a key with millions of duplicates costs one partial
    row per task. Without ``order_by`` it is ``dropDuplicates`` (any one row).

    Streams: ``dropDuplicates`` keeps the first arrival and holds every key in
    state forever; ``within_watermark=True`` uses
    ``dropDuplicatesWithinWatermark``, which forgets a key once the watermark
    passes its first event time + delay (needs ``withWatermark`` upstream).
    """
    if within_watermark:
        return df.dropDuplicatesWithinWatermark(list(keys))
    if not order_by or df.isStreaming:
        return df.dropDuplicates(list(keys))
    cols = df.columns
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order_by]))
    return df.groupBy(*keys).agg(best.alias("__row")).select("__row.*")


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], time_column: str, delay: str) -> DataFrame:
    """``withWatermark`` + ``dropDuplicatesWithinWatermark`` on an unwatermarked stream.

    Every row is shuffled to the task that owns its key, so a key with a large
    share of the rows makes one long task; which of its rows is the first to
    arrive is for that task to say, so nothing is dropped ahead of it.
    """
    return df.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(list(keys))


def dedup_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    time_column: str,
    every: str,
) -> DataFrame:
    """The first row of each key in every event-time window of length ``every``, on batch frames and streams alike.

    "First" is by ``order_by``, not by arrival: the window's rows are aggregated with ``min_by``, and on a watermarked
    stream in append mode the row that stays is emitted when the watermark has passed the window's end, however
    the rows were dealt to batches. State holds one row for each key and open window, and partial aggregation runs before the shuffle, so a
    key with many copies costs one row a task. Rows with a NULL time are in no window; a NULL key is a key.
    """
    row = F.min_by(F.struct(*map(F.col, df.columns)), F.struct(*map(F.col, order_by)))
    first = df.groupBy(F.window(time_column, every).alias("__window"), *keys).agg(row.alias("__row"))
    return first.select("__row.*")
