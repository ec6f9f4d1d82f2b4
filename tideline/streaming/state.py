"""The state of a streaming query as rows.

Spark's state data sources read the state store files of a checkpoint (default or RocksDB store) as a
DataFrame, one input partition for each state partition, without the query running. ``state_rows`` gives key and value
structs of one stateful operator, ``open_windows`` the windows that a watermarked aggregate still holds,
with their partial aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def state_metadata(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator and store: operator, store name, state partitions, batch range."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(
    spark: SparkSession,
    checkpoint: str,
    batch_id: int | None = None,
    operator_id: int = 0,
    store: str | None = None,
    join_side: str | None = None,
) -> DataFrame:
    """``key`` and ``value`` structs and ``partition_id`` of a stateful operator after a committed batch (default: the last).

    ``store`` names one of several state stores of an operator; ``join_side`` ("left" or "right") gives the buffered rows of a
    stream-stream join instead.
    """
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    if store is not None:
        reader = reader.option("storeName", store)
    if join_side is not None:
        reader = reader.option("joinSide", join_side)
    return reader.load(checkpoint)


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str],
    values: Mapping[str, str],
    batch_id: int | None = None,
    operator_id: int = 0,
) -> DataFrame:
    """``start, end, *keys`` and partial aggregates of the windows in state.

    ``values`` maps output names to fields of the state's value struct (the aggregation buffers, for example
    ``count`` of a count, ``sum`` and ``count`` of an average).
    """
    rows = state_rows(spark, checkpoint, batch_id, operator_id)
    window: Column = F.col("key")[rows.schema["key"].dataType[0].name]
    return rows.select(
        window["start"].alias("start"),
        window["end"].alias("end"),
        *[F.col("key")[k].alias(k) for k in keys],
        *[F.col("value")[v].alias(name) for name, v in values.items()],
    )
