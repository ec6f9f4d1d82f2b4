"""Joins of two streams within a time bound."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    within: str,
    how: str = "inner",
    prefix: str = "right_",
) -> DataFrame:
    """Pairs of equal ``keys`` with the right time at or up to ``within`` after the left one.

    Right columns get ``prefix``. ``how``: inner, left_outer, right_outer or full_outer. On streams both sides need a watermark: with the bound it tells
    Spark when a buffered row can meet no partner any more, so state is bounded, and an outer join
    emits a row without partner when the watermark has passed that point. A NULL key or time meets nothing.
    """
    if how not in ("inner", "left_outer", "right_outer", "full_outer"):
        raise ValueError(f"unknown join {how!r}")
    if not keys:
        raise ValueError("an interval join needs key columns")
    renamed = right.select(*[F.col(c).alias(prefix + c) for c in right.columns])
    same: list[Column] = [F.col(k) == F.col(prefix + k) for k in keys]
    begin, at = F.col(left_time), F.col(prefix + right_time)
    bound = [at >= begin, at <= begin + F.expr(f"INTERVAL {within}")]
    return left.join(renamed, functools.reduce(Column.__and__, [*same, *bound]), how)
