"""Late rows told apart instead of only dropped.

A windowed aggregate drops a row silently when every window of it ended at or before the watermark that
the batch before last left behind. ``LateSplitter`` applies the same rule to the rows of each batch and
writes them all, those that an aggregate counts and those that come too late, in one pass; rows without
a time fall in no window. The watermark is the query's own, from the offsets log of its checkpoint, so a replayed
batch is split alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.streaming.inspect import checkpoint_offsets
from tideline.streaming.sinks import batch_dir

COUNTED, LATE, NO_TIME = "counted", "late", "no_time"


def late_watermark_ms(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark (ms) by which batch ``batch_id`` judges its rows: that of the batch before it; 0 for the first."""
    before = checkpoint_offsets(spark, checkpoint).where(F.col("batch_id") == batch_id - 1)
    row = before.agg(F.max("watermark_ms").alias("ms")).first()
    return row["ms"] or 0


def _micros(duration: str) -> Column:
    """A duration as microseconds, for the arithmetic of windows."""
    begin = F.timestamp_micros(F.lit(0))
    return F.unix_micros(begin + F.expr(f"INTERVAL {duration}"))


def last_window_end(time: Column, size: str, slide: str | None = None) -> Column:
    """The end (microseconds) of the last window that holds ``time``."""
    at, step = F.unix_micros(time), _micros(slide or size)
    return at - F.pmod(at, step) + _micros(size)


class LateSplitter:
    """``foreachBatch`` callback on a watermarked stream: each batch's rows in folders ``fate=counted``, ``late``, ``no_time``.

    ``checkpoint`` is that of the query which it is given to. A replayed batch replaces its folder.
    """

    def __init__(self, path: str, checkpoint: str, time_column: str, size: str, slide: str | None = None):
        self.path, self.checkpoint = path, checkpoint
        self.time_column, self.size, self.slide = time_column, size, slide

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        watermark = late_watermark_ms(spark, self.checkpoint, batch_id) * 1000
        time = F.col(self.time_column)
        late = last_window_end(time, self.size, self.slide) <= F.lit(watermark)
        fate = F.when(time.isNull(), NO_TIME).when(late, LATE).otherwise(COUNTED)
        (
            batch_df.withColumn("fate", fate)
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .partitionBy("fate")
            .parquet(batch_dir(self.path, batch_id))
        )


def read_split(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a :class:`LateSplitter` with ``fate`` and ``batch_id``; ``schema`` is that of the stream's rows.

    A batch folder is its own partitioned table, so a batch without any late row needs no folder for them.
    """
    fate = F.regexp_extract(F.col("_metadata.file_path"), "/fate=([^/]*)/", 1).alias("fate")
    files = spark.read.schema(f"{schema}, batch_id BIGINT").option("recursiveFileLookup", "true")
    return files.parquet(path).select("*", fate)
