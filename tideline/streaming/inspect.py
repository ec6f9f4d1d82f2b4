"""Checkpoints and query progress as DataFrames.

A checkpoint's ``offsets/<batch>`` file holds ``v1``, a JSON line of batch
metadata (watermark, batch timestamp, frozen confs), then one line per source
(file source: ``{"logOffset":n}``; Kafka: ``{"topic":{"partition":offset}}``,
the end offsets planned for the batch). ``commits/<batch>`` exists once the
batch has been fully written. Both are read with Spark's text source, so this
works on any file system the checkpoint lives on.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_METADATA = "batchWatermarkMs BIGINT, batchTimestampMs BIGINT, conf MAP<STRING, STRING>"


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.text(folder, wholetext=True)
        .select(
            F.col("_metadata.file_name").cast("long").alias("batch_id"),
            F.col("value"),
        )
        .where(F.col("batch_id").isNotNull())
    )


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per (batch, source): ``batch_id, watermark_ms, batch_ts_ms,
    source_index, source_offset, log_offset, committed, conf``.

    ``conf`` holds the session settings frozen into the checkpoint (state
    partitions, state store provider, format versions): a restart keeps them
    whatever the session says.
    """
    offsets = _log(spark, f"{checkpoint}/offsets")
    lines = offsets.select("batch_id", F.posexplode(F.split(F.col("value"), "\n")).alias("pos", "line"))
    meta = lines.where(F.col("pos") == 1).select(
        "batch_id", F.from_json("line", _METADATA).alias("m")
    )
    sources = lines.where((F.col("pos") >= 2) & (F.length("line") > 0)).select(
        "batch_id",
        (F.col("pos") - 2).alias("source_index"),
        F.col("line").alias("source_offset"),
        F.get_json_object("line", "$.logOffset").cast("long").alias("log_offset"),
    )
    commits = _log(spark, f"{checkpoint}/commits").select("batch_id", F.lit(True).alias("committed"))
    return (
        meta.join(sources, "batch_id")
        .join(commits, "batch_id", "left")
        .select(
            "batch_id",
            F.col("m.batchWatermarkMs").alias("watermark_ms"),
            F.col("m.batchTimestampMs").alias("batch_ts_ms"),
            "source_index",
            "source_offset",
            "log_offset",
            F.coalesce(F.col("committed"), F.lit(False)).alias("committed"),
            F.col("m.conf").alias("conf"),
        )
    )


def kafka_offsets(offsets: DataFrame) -> DataFrame:
    """Explode Kafka source offsets (``{"topic":{"partition":offset}}``) of
    ``checkpoint_offsets`` rows into ``batch_id, topic, partition, end_offset``.

    The logged offsets are the exclusive end offsets planned for the batch.
    """
    parsed = offsets.select(
        "batch_id", F.from_json("source_offset", "MAP<STRING, MAP<STRING, BIGINT>>").alias("m")
    ).where(F.col("m").isNotNull())
    by_topic = parsed.select("batch_id", F.explode("m").alias("topic", "parts"))
    return by_topic.select(
        "batch_id", "topic", F.explode("parts").alias("partition", "end_offset")
    ).withColumn("partition", F.col("partition").cast("int"))


_PROGRESS = (
    "batch_id BIGINT, timestamp STRING, num_input_rows BIGINT, input_rows_per_second DOUBLE, "
    "processed_rows_per_second DOUBLE, trigger_ms BIGINT, watermark STRING, "
    "state_rows BIGINT, state_rows_dropped_by_watermark BIGINT, sink STRING, "
    "observed MAP<STRING, MAP<STRING, STRING>>"
)


def _observed(progress) -> dict[str, dict[str, str]]:
    given = progress.get("observedMetrics") if isinstance(progress, dict) else progress.observedMetrics
    rows = {name: row.asDict() if hasattr(row, "asDict") else dict(row) for name, row in (given or {}).items()}
    return {name: {k: None if v is None else str(v) for k, v in row.items()} for name, row in rows.items()}


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """``recentProgress`` (bounded by spark.sql.streaming.numRecentProgressUpdates) as rows.

    ``observed`` holds the metrics that ``Dataset.observe`` gathered inside the plan, by name and as text.
    """
    rows = []
    for p in query.recentProgress:
        d = p if isinstance(p, dict) else json.loads(p.json)
        ops = d.get("stateOperators") or []
        rows.append(
            (
                d.get("batchId"),
                d.get("timestamp"),
                d.get("numInputRows"),
                float(d.get("inputRowsPerSecond") or 0.0),
                float(d.get("processedRowsPerSecond") or 0.0),
                (d.get("durationMs") or {}).get("triggerExecution"),
                (d.get("eventTime") or {}).get("watermark"),
                sum(o.get("numRowsTotal", 0) for o in ops) if ops else None,
                sum(o.get("numRowsDroppedByWatermark", 0) for o in ops) if ops else None,
                (d.get("sink") or {}).get("description"),
                _observed(p),
            )
        )
    return spark.createDataFrame(rows, _PROGRESS)
