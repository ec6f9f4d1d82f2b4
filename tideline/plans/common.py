"""Shared plumbing for the catalogue: staged replays, parsing chain, run-and-read helpers."""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tideline.functions import decode, parse_json, to_event_time
from tideline.functions.codec import TRANSACTION_DDL, WIDE_DDL
from tideline.session import pin_utc, scratch_path
from tideline.sources.replay import (
    DEFAULT_TOPIC,
    EVEN,
    BatchRule,
    StagedTopic,
    records_from_events,
    read_replay,
    stage_topic,
)
from tideline.streaming import ChangelogWriter, checkpoint_offsets, read_changelog, run
from tideline.streaming.sinks import read_latest_batch

_STAGED: dict[tuple, StagedTopic] = {}

# Target bytes of input per state partition when a checkpoint is created.
_BYTES_PER_STATE_PARTITION = 64 << 20


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def staged(
    spark: SparkSession, sf_dir: str, rule: BatchRule = EVEN, value_mode: str = "clean"
) -> StagedTopic:
    """Stage ``events`` as a replay topic once per session and rule."""
    pin_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir, rule, value_mode)
    if key not in _STAGED:
        _STAGED[key] = stage_topic(
            spark, events(spark, sf_dir), scratch_path(spark, "stage"), rule, value_mode=value_mode
        )
    return _STAGED[key]


def state_partitions(spark: SparkSession, st: StagedTopic) -> int:
    """State/shuffle partitions for a new checkpoint, sized from the staged input.

    Never more than the session's ``spark.sql.shuffle.partitions`` (the
    cluster's choice), never fewer than the default parallelism; stateful
    shuffles are pinned to this number for the checkpoint's lifetime.
    """
    size = st.bytes
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(spark.sparkContext.defaultParallelism, math.ceil(size / _BYTES_PER_STATE_PARTITION))
    return max(1, min(configured, wanted))


def stream_transactions(
    spark: SparkSession,
    sf_dir: str,
    rule: BatchRule = EVEN,
    value_mode: str = "clean",
    corrupt_column: str | None = None,
    keep: tuple[str, ...] = ("offset",),
) -> tuple[DataFrame, StagedTopic]:
    """Replay stream -> decode -> from_json -> ``data.*`` (plus ``keep`` envelope columns).

    User ids are BIGINT as in the table; in the fixture of bad records they stay INT, for one of its faults is their overflow.
    """
    schema = WIDE_DDL if value_mode == "clean" else TRANSACTION_DDL
    st = staged(spark, sf_dir, rule, value_mode)
    # The original workload's topic name carries a trailing space; it is trimmed.
    raw = read_replay(spark, st, subscribe=DEFAULT_TOPIC + " ")
    parsed = parse_json(decode(raw, key=False, keep=keep), schema, keep=keep, corrupt_column=corrupt_column)
    return parsed, st


def batch_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as a batch frame, projected straight from the table."""
    return records_from_events(events(spark, sf_dir))


def event_time(df: DataFrame) -> DataFrame:
    return to_event_time(df, "timestamp", "seconds")


def report(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall clock (TIMESTAMP_NTZ) for comparison with other engines."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def latest_batch(changelog: DataFrame) -> DataFrame:
    """Rows of the highest ``batch_id`` (complete mode: the final result)."""
    top = changelog.agg(F.max("batch_id").alias("batch_id"))
    return changelog.join(top, "batch_id").drop("batch_id")


def run_to_parquet(df: DataFrame, st: StagedTopic, **kw: Any) -> DataFrame:
    spark = df.sparkSession
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(df, "parquet", "append", path=out, checkpoint=ck, **_partitions(spark, st, kw))
    return spark.read.parquet(out)


def run_complete(df: DataFrame, st: StagedTopic, evidence: bool = False, **kw: Any) -> DataFrame:
    """Complete mode into per-batch folders; returns the final result (newest folder only).

    With ``evidence`` each row tells how many batches the query ran (``batches``).
    """
    spark = df.sparkSession
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(
        df,
        "foreach_batch",
        "complete",
        target=ChangelogWriter(out),
        checkpoint=ck,
        **_partitions(spark, st, kw),
    )
    last = read_latest_batch(spark, out)
    if not evidence:
        return last
    batches = checkpoint_offsets(spark, ck).where("committed").agg(F.count_distinct("batch_id").alias("batches"))
    return last.join(F.broadcast(batches))


def run_to_changelog(df: DataFrame, st: StagedTopic, mode: str, **kw: Any) -> DataFrame:
    spark = df.sparkSession
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(
        df,
        "foreach_batch",
        mode,
        target=ChangelogWriter(out),
        checkpoint=ck,
        **_partitions(spark, st, kw),
    )
    return read_changelog(spark, out)


def _partitions(spark: SparkSession, st: StagedTopic, kw: dict[str, Any]) -> dict[str, Any]:
    if "shuffle_partitions" not in kw:
        kw = dict(kw, shuffle_partitions=state_partitions(spark, st))
    return kw
