"""One entry point to start a streaming query, with early validation.

``start`` maps a sink name, output mode and trigger onto ``DataStreamWriter``
and rejects combinations Spark would only refuse later (or never): file and
table sinks take append only, ``foreach_batch`` and ``foreach`` take a callable
or writer, exactly one trigger. ``run`` drives a query to completion and raises
its failure.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

FILE_SINKS = ("parquet", "json", "csv", "orc", "text")
SINKS = FILE_SINKS + ("memory", "console", "table", "kafka", "noop", "foreach_batch", "foreach")
MODES = ("append", "update", "complete")

_STATE_STORES = {
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def state_store_provider(spark) -> str:
    """The state store provider new checkpoints will use (HDFS-backed unless set)."""
    return spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or _STATE_STORES["hdfs"]


_STARTING = threading.Lock()


@contextmanager
def _session_conf(spark, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings for a query that is about to start.

    A query copies its session's settings when it starts, so they are put back
    at once; starts with settings of their own wait for one another.
    """
    if not conf:
        yield
        return
    with _STARTING:
        previous = {k: spark.conf.get(k, None) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in previous.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


def _query_conf(state_store: str | None, shuffle_partitions: int | None) -> dict[str, str]:
    conf: dict[str, str] = {}
    if state_store is not None:
        conf["spark.sql.streaming.stateStore.providerClass"] = _STATE_STORES[state_store]
        if state_store == "rocksdb":
            # Changelog checkpointing uploads only the per-batch delta of the
            # state instead of snapshots of the whole store.
            conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(int(shuffle_partitions))
    return conf


@dataclass(frozen=True)
class Trigger:
    """Exactly one trigger kind; ``Trigger()`` is the default micro-batch trigger."""

    available_now: bool = False
    once: bool = False
    processing_time: str | None = None
    continuous: str | None = None

    def __post_init__(self) -> None:
        chosen = [self.available_now, self.once, self.processing_time is not None, self.continuous is not None]
        if sum(chosen) > 1:
            raise ValueError("only one trigger may be set")

    @property
    def finite(self) -> bool:
        return self.available_now or self.once

    def kwargs(self) -> dict[str, Any]:
        if self.available_now:
            return {"availableNow": True}
        if self.once:
            return {"once": True}
        if self.processing_time is not None:
            return {"processingTime": self.processing_time}
        if self.continuous is not None:
            return {"continuous": self.continuous}
        return {}


AVAILABLE_NOW = Trigger(available_now=True)


def _check(
    sink: str, mode: str, target: Any, path: str | None, name: str | None, trigger: Trigger, fmt: str
) -> None:
    if sink not in SINKS:
        raise ValueError(f"unknown sink {sink!r}; one of {SINKS}")
    if mode not in MODES:
        raise ValueError(f"unknown output mode {mode!r}; one of {MODES}")
    if (sink in FILE_SINKS or (sink == "table" and fmt in FILE_SINKS)) and mode != "append":
        raise ValueError(
            f"the {sink} sink takes append mode only; for update/complete results use "
            "foreach_batch with MergeWriter or an overwriting callback"
        )
    if sink in FILE_SINKS and not path:
        raise ValueError(f"the {sink} sink needs a path")
    if sink == "table" and not target:
        raise ValueError("the table sink needs a table name")
    if sink == "memory" and not name:
        raise ValueError("the memory sink needs a query name (the table name)")
    if sink in ("foreach_batch", "foreach") and target is None:
        raise ValueError(f"the {sink} sink needs a callable or writer")
    if trigger.continuous is not None and sink in ("foreach_batch", "table") + FILE_SINKS:
        raise ValueError(f"continuous processing does not support the {sink} sink")


def start(
    df: DataFrame,
    sink: str,
    mode: str = "append",
    trigger: Trigger = AVAILABLE_NOW,
    checkpoint: str | None = None,
    name: str | None = None,
    path: str | None = None,
    target: Any = None,
    options: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    state_store: str | None = None,
    shuffle_partitions: int | None = None,
) -> StreamingQuery:
    """Start ``df`` into ``sink``.

    ``state_store`` ("hdfs" or "rocksdb") and ``shuffle_partitions`` (state
    partitions) hold for this query alone; both are frozen into a checkpoint by
    its first batch, so on a restart the stored values win.

    ``target`` is the table name (``table``), the ``fn(batch_df, batch_id)``
    callable (``foreach_batch``) or the row writer (``foreach``). ``fmt`` is the
    table format. A checkpoint is required for every sink that outlives the
    session (all but memory, console and noop).
    """
    _check(sink, mode, target, path, name, trigger, fmt)
    if checkpoint is None and sink not in ("memory", "console", "noop"):
        raise ValueError(f"the {sink} sink needs a checkpoint location")
    w = df.writeStream.outputMode(mode)
    if name:
        w = w.queryName(name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if options:
        w = w.options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    kw = trigger.kwargs()
    if kw:
        w = w.trigger(**kw)
    with _session_conf(df.sparkSession, _query_conf(state_store, shuffle_partitions)):
        if sink == "foreach_batch":
            return w.foreachBatch(target).start()
        if sink == "foreach":
            return w.foreach(target).start()
        if sink == "table":
            return w.format(fmt).toTable(target)
        w = w.format(sink)
        return w.start(path) if sink in FILE_SINKS else w.start()


def await_done(q: StreamingQuery, trigger: Trigger, timeout: float | None = None) -> StreamingQuery:
    """Wait for a finite trigger, or drain available input and stop an endless one.

    ``timeout`` (seconds; none by default) bounds the wait for a finite trigger only.
    """
    if timeout is not None and not trigger.finite:
        raise ValueError("a timeout needs a finite trigger")
    try:
        if trigger.finite:
            if timeout is None:
                q.awaitTermination()
            elif not q.awaitTermination(timeout):
                q.stop()
                raise TimeoutError(f"query {q.name or q.id} did not finish in {timeout}s")
        else:
            q.processAllAvailable()
            q.stop()
    finally:
        err = q.exception()
    if err is not None:
        raise RuntimeError(f"query {q.name or q.id} failed: {err}")
    return q


def run(
    df: DataFrame,
    sink: str,
    mode: str = "append",
    trigger: Trigger = AVAILABLE_NOW,
    timeout: float | None = None,
    **kw: Any,
) -> StreamingQuery:
    """``start`` then ``await_done``; returns the finished query."""
    if trigger.continuous is not None:
        raise ValueError("a continuous query never drains; use start() and stop() it")
    return await_done(start(df, sink, mode, trigger, **kw), trigger, timeout)
