"""DataFrame -> DataFrame operators; each runs unchanged on batch and streaming frames."""

from tideline.operators.aggregate import (
    chained_window_agg,
    count_by,
    count_named,
    distinct_count,
    distinct_sketch,
    merge_sketches,
    window_agg,
)
from tideline.operators.watermark import with_watermark
from tideline.operators.dedup import dedup, dedup_first, dedup_within_watermark
from tideline.operators.join import interval_join
from tideline.operators.validate import split_valid, with_reasons

__all__ = [
    "chained_window_agg",
    "count_by",
    "count_named",
    "dedup",
    "dedup_first",
    "dedup_within_watermark",
    "distinct_count",
    "distinct_sketch",
    "interval_join",
    "merge_sketches",
    "split_valid",
    "with_reasons",
    "window_agg",
    "with_watermark",
]
