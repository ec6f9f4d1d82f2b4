"""Grouped and event-time-windowed aggregates.

All are ``groupBy().agg()`` so Spark plans partial aggregation before the
shuffle (map-side combine): a hot key costs one partial row per task, not one
row per event. On a stream the same plan gains the state-store restore/save
steps; with a watermark, closed windows are evicted from state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """``groupBy(keys).count()``: rows per key as ``count`` (NULL keys form a group; counts all rows)."""
    return df.groupBy(*keys).count()


def count_named(df: DataFrame, column: str, keys: Sequence[str], name: str) -> DataFrame:
    """``count(column)`` per key, named: NULLs in ``column`` are not counted."""
    return df.groupBy(*keys).agg(F.count(column).alias(name))


def window_agg(
    df: DataFrame,
    time_column: str,
    size: str,
    slide: str | None = None,
    keys: Sequence[str] = (),
    aggs: Sequence[Column] = (),
    ntz: bool = False,
) -> DataFrame:
    """Aggregate per event-time window (tumbling, or sliding when ``slide`` is set) and keys.

    Windows are epoch-aligned, half-open ``[start, end)``; rows with a NULL time
    fall in no window. Output is flat: ``start, end, *keys, *aggs``. ``ntz``
    reports bounds as TIMESTAMP_NTZ (UTC wall clock).
    """
    w = F.window(time_column, size, slide) if slide else F.window(time_column, size)
    out = df.groupBy(w.alias("window"), *keys).agg(*aggs)
    start, end = F.col("window.start"), F.col("window.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return out.select(start.alias("start"), end.alias("end"), *keys, *[a for a in out.columns if a not in ("window", *keys)])


def distinct_count(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    name: str,
    rsd: float | None = None,
) -> DataFrame:
    """Distinct values of ``column`` per key.

    Exact (``count(DISTINCT)``) on batch frames. Streams reject exact distinct
    aggregation, so there (or when ``rsd`` is given) it is the HyperLogLog++
    estimate ``approx_count_distinct`` with relative standard deviation ``rsd``
    (default 0.05), whose state is a fixed-size sketch per key.
    """
    if df.isStreaming or rsd is not None:
        agg = F.approx_count_distinct(column, rsd if rsd is not None else 0.05)
    else:
        agg = F.count_distinct(F.col(column))
    return df.groupBy(*keys).agg(agg.alias(name))


def chained_window_agg(
    df: DataFrame,
    time_column: str,
    inner: str,
    outer: str,
    keys: Sequence[str],
    inner_aggs: Sequence[Column],
    outer_aggs: Sequence[Column],
    ntz: bool = False,
) -> DataFrame:
    """An aggregate over windows of an aggregate over windows, for example a day's highest hourly count.

    ``outer_aggs`` see the columns of ``inner_aggs`` and ``start``, ``end`` of the inner window. On a stream these are two stateful operators in
    one query: the first hands a window on when the watermark has passed its end, the second emits an outer window when what the
    first let through has passed the outer end. An inner window belongs to the outer one that holds its last instant.
    """
    first = df.groupBy(F.window(time_column, inner).alias("__inner"), *keys).agg(*inner_aggs)
    first = first.select("*", F.col("__inner.start").alias("start"), F.col("__inner.end").alias("end"))
    second = first.groupBy(F.window(F.window_time("__inner"), outer).alias("window"), *keys).agg(*outer_aggs)
    start, end = F.col("window.start"), F.col("window.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return second.select(start.alias("start"), end.alias("end"), *keys, *[c for c in second.columns if c not in ("window", *keys)])


def distinct_sketch(df: DataFrame, keys: Sequence[Column | str], column: str, lg_k: int = 15) -> DataFrame:
    """A mergeable sketch of the distinct values of ``column`` per key (HyperLogLog with ``2 ** lg_k`` registers).

    Up to about ``2 ** lg_k * 3 / 32`` distinct values a sketch holds them one by one (3,072 at 15) and its rounded estimate is in practice
    exact; beyond, its relative standard error is 1.04 / sqrt(2 ** lg_k) (0.6 % at 15). NULLs do not count.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """Distinct values per key from stored sketches alone: their union, and its estimate as ``name``."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")
