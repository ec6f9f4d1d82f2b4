"""Restarts after a failure, and a record of which batches were tried how often."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def run_with_restarts(
    build: Callable[[], StreamingQuery],
    restarts: int = 3,
    retry_on: Callable[[Exception], bool] = lambda error: True,
    pause: float = 0.0,
) -> tuple[StreamingQuery, int]:
    """Run a query and start it again on its checkpoint when it fails; returns it and the number of restarts.

    ``build`` starts the query anew and drives it to its end (for example by :func:`tideline.streaming.run`), with
    the same checkpoint every time: the batch that failed runs again with the same ``batch_id`` and the same rows, and goes on from there.
    An error that ``retry_on`` refuses, or one more than ``restarts``, is raised. ``pause`` seconds double with every restart.
    """
    for again in range(restarts + 1):
        try:
            return build(), again
        except Exception as error:  # noqa: BLE001 - what to retry is the caller's choice
            if again == restarts or not retry_on(error):
                raise
            if pause:
                time.sleep(pause * 2**again)
    raise ValueError("restarts must not be negative")


class AttemptLog:
    """``foreachBatch`` wrapper: a row for each time that a batch is given to ``target``, written before it runs."""

    def __init__(self, target: Callable[[DataFrame, int], None], path: str):
        self.target, self.path = target, path

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")).write.mode("append").parquet(self.path)
        self.target(batch_df, batch_id)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """batch_id, attempts of an :class:`AttemptLog`."""
    return spark.read.parquet(path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("attempts"))
