"""Delivery of rows to an external system from the executors.

``DeliveryWriter`` sends each micro-batch in chunks, from all executors at once. A chunk has an idempotency key made of
batch, partition and place, and rows are dealt and ordered by columns of their own, so a retried chunk, a task that runs again
and a replayed batch all send the same rows under the same keys. A receiver that keeps one delivery per key then
holds every row once. ``OutboxSender`` is such a receiver: a folder with one file per key.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from tideline.streaming.files import arrow_target
from tideline.streaming.sinks import batch_dir


class Sender(Protocol):
    """What a receiver offers to an executor; it is pickled, so it opens its connection in ``send``."""

    def send(self, key: str, rows: pa.RecordBatch, attempt: int) -> None:
        """Deliver a chunk; raise to have it sent again. A key that was delivered before must change nothing."""


class DeliveryWriter:
    """``foreachBatch`` callback: rows go to ``sender`` by partition, each chunk with at most ``tries`` attempts.

    ``order_by`` must order the rows totally. A chunk that fails ``tries`` times fails its task, which Spark runs again, and then the
    batch, which is replayed on restart. What was delivered, with attempts, is written as receipts by batch.
    """

    def __init__(
        self,
        sender: Sender,
        receipts: str,
        order_by: Sequence[str],
        partitions: int = 8,
        chunk_rows: int = 1000,
        tries: int = 3,
        pause: float = 0.0,
    ):
        if tries < 1 or chunk_rows < 1:
            raise ValueError("tries and chunk_rows must be 1 or more")
        self.sender, self.receipts, self.order_by = sender, receipts, list(order_by)
        self.partitions, self.chunk_rows, self.tries, self.pause = partitions, chunk_rows, tries, pause

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        dealt = batch_df.repartition(self.partitions, *self.order_by).sortWithinPartitions(*self.order_by)
        sent = dealt.mapInArrow(
            _deliver(self.sender, batch_id, self.chunk_rows, self.tries, self.pause),
            "batch_id BIGINT, delivery STRING, rows BIGINT, attempts INT",
        )
        sent.write.mode("overwrite").parquet(batch_dir(self.receipts, batch_id))


def _deliver(sender: Sender, batch_id: int, chunk_rows: int, tries: int, pause: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, place = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def out(chunk: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal place
            key = f"{batch_id:08d}-{partition:05d}-{place:06d}"
            place += 1
            for attempt in range(1, tries + 1):
                try:
                    sender.send(key, chunk, attempt)
                    break
                except Exception:  # noqa: BLE001 - whatever the receiver raises
                    if attempt == tries:
                        raise
                    time.sleep(pause * 2 ** (attempt - 1))
            return pa.RecordBatch.from_pydict(
                {
                    "batch_id": pa.array([batch_id], pa.int64()), "delivery": [key],
                    "rows": pa.array([chunk.num_rows], pa.int64()), "attempts": pa.array([attempt], pa.int32()),
                }
            )

        def chunks() -> Iterator[pa.RecordBatch]:
            # Arrow batches end where Spark ends them; chunks do not depend on that.
            n = 0
            for batch in batches:
                while n + batch.num_rows >= chunk_rows:
                    cut = chunk_rows - n
                    held.append(batch.slice(0, cut))
                    batch, n = batch.slice(cut), 0
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held.clear()
                if batch.num_rows:
                    held.append(batch)
                    n += batch.num_rows
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for chunk in chunks():
            yield out(chunk)

    return run


class OutboxSender:
    """A receiver on the shared folder: one Parquet file for each key, named by it; a second delivery replaces it by itself.

    The file is written under a hidden name and renamed, so readers see whole deliveries only. ``attempt`` is kept beside the rows.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def send(self, key: str, rows: pa.RecordBatch, attempt: int) -> None:
        filesystem, root = arrow_target(self.path)
        filesystem.create_dir(root, recursive=True)
        table = pa.Table.from_batches([rows])
        table = table.append_column("delivery", pa.array([key] * rows.num_rows, pa.string()))
        table = table.append_column("attempt", pa.array([attempt] * rows.num_rows, pa.int32()))
        hidden = f"{root}/.{key}-{uuid.uuid4().hex}.tmp"
        pq.write_table(table, hidden, filesystem=filesystem)
        filesystem.move(hidden, f"{root}/{key}.parquet")


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    """Rows received by an :class:`OutboxSender`, with ``delivery`` and ``attempt``."""
    return spark.read.parquet(path)
