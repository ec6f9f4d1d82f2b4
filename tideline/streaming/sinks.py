"""Per-batch and per-row sink writers.

The file writers are idempotent per ``batch_id`` / epoch: a replayed batch
overwrites the folder or files its first attempt wrote, though ``foreachBatch``
and ``foreach`` may call twice. ``JdbcWriter`` is not: a replayed batch is
appended again, and its ``batch_id`` column tells the copies apart.
All output goes to folders the caller chooses under the shared folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.streaming.files import arrow_target, exists, list_names, remove


def batch_dir(path: str, batch_id: int) -> str:
    return f"{path}/batch-{batch_id:08d}"


class ChangelogWriter:
    """``foreachBatch`` callback: each batch's rows, tagged ``batch_id``, in its own folder.

    With update mode this is the changelog of an aggregate (keys touched in a
    batch with their running values); with append mode, the appended rows. ``partition_by`` (for example a
    day) parts each batch's folder, so that :func:`compact_closed` can take closed days out of all batches.
    """

    def __init__(self, path: str, columns: Sequence[str] | None = None, partition_by: Sequence[str] = ()):
        self.path = path
        self.columns = list(columns) if columns else None
        self.partition_by = list(partition_by)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        df = batch_df.select(*self.columns) if self.columns else batch_df
        (
            df.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .partitionBy(*self.partition_by)
            .parquet(batch_dir(self.path, batch_id))
        )


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all complete batches (``_SUCCESS`` present): a batch that is being written is not seen."""
    done = [batch_dir(path, b) for b in completed_batches(path)]
    if not done:
        raise FileNotFoundError(f"no completed batch under {path}")
    return spark.read.parquet(*done)


def completed_batches(path: str) -> Iterator[int]:
    """Ids of the batches whose folder is complete (``_SUCCESS`` present), the newest first."""
    for b in sorted((int(n[6:]) for n in list_names(path) if n.startswith("batch-")), reverse=True):
        if exists(f"{batch_dir(path, b)}/_SUCCESS"):
            yield b


def read_latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest completed batch folder (complete mode: the current result)."""
    for b in completed_batches(path):
        return spark.read.parquet(batch_dir(path, b)).drop("batch_id")
    raise FileNotFoundError(f"no completed batch under {path}")


def newest_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the highest ``batch_id`` for each key, by a partial aggregate. A NULL key is a key."""
    values = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return log.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def read_latest_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key of an update-mode changelog.

    A batch adds only the keys that it changed, so nothing written before is read or rewritten
    while the stream runs.
    """
    return newest_rows(read_changelog(spark, path), keys).drop("batch_id")


def compact_closed(spark: SparkSession, path: str, keys: Sequence[str], part: str, before: str) -> list[str]:
    """Take closed partitions out of a changelog; returns their values.

    ``part`` is the column by which a :class:`ChangelogWriter` parts its batches (text that orders as time does, such as a
    day), ``before`` the first value that may still change, for example the watermark's day. The newest rows of each earlier value are
    written to ``closed/<part>=...`` and the value's folders are removed from all batches. A value that is compacted twice, or a run that
    ended in between, gives the same rows, for what is in both places is one row by its key. A value's keys must
    not occur under another one.
    """
    batches = [batch_dir(path, b) for b in completed_batches(path)]
    folders = {f"{b}/{n}": n.split("=", 1)[1] for b in batches for n in list_names(b) if n.startswith(f"{part}=")}
    closed = {f: v for f, v in folders.items() if v < before}
    if not closed:
        return []
    # every batch is a partitioned table of its own: the part is taken from the file's path
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*closed).withColumn(part, F.regexp_extract(F.col("_metadata.file_path"), f"/{part}=([^/]*)/", 1))
    kept = f"{path}/closed"
    if exists(kept):
        again = spark.read.parquet(kept).where(F.col(part).cast("string").isin(*set(closed.values())))
        rows = rows.unionByName(again.withColumn(part, F.col(part).cast("string")))
    newest = newest_rows(rows, keys).repartition(part)
    newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(kept)
    for folder in closed:
        remove(folder)
    return sorted(set(closed.values()))


def read_compacted(spark: SparkSession, path: str, keys: Sequence[str], part: str) -> DataFrame:
    """The newest row of each key of a changelog and of what :func:`compact_closed` took out of it, with ``compacted``."""
    sources = []
    live = [b for b in completed_batches(path) if any(n.startswith(f"{part}=") for n in list_names(batch_dir(path, b)))]
    if live:
        files = spark.read.option("recursiveFileLookup", "true").parquet(*[batch_dir(path, b) for b in live])
        sources.append(files.withColumn("compacted", F.lit(False)))
    if exists(f"{path}/closed"):
        sources.append(spark.read.parquet(f"{path}/closed").drop(part).withColumn("compacted", F.lit(True)))
    if not sources:
        raise FileNotFoundError(f"no completed batch under {path}")
    log = sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1])
    return newest_rows(log, keys).drop("batch_id")


class TopicWriter:
    """``foreachBatch`` callback writing Kafka sink records (``key``, ``value``) to a topic folder.

    The record contract is the Kafka sink's; use ``writeStream.format("kafka")``
    (sink ``kafka``) where the connector is installed.
    """

    def __init__(self, path: str, topic: str):
        self.path = path
        self.topic = topic.strip()

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        (
            batch_df.select(
                F.col("key").cast("string").alias("key"),
                F.col("value").cast("string").alias("value"),
                F.lit(self.topic).alias("topic"),
                F.lit(batch_id).cast("long").alias("batch_id"),
            )
            .write.mode("overwrite")
            .parquet(batch_dir(self.path, batch_id))
        )


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    """The records of all complete batches."""
    return read_changelog(spark, path)


class JdbcWriter:
    """``foreachBatch`` callback appending each batch to a JDBC table.

    The batch is written by the executors in parallel (``numPartitions`` caps
    the connections). Rows carry ``batch_id``; on a replayed batch the rows of
    that id are written again, so readers should de-duplicate on it, or the
    table should have a key on (key columns, batch_id).
    """

    def __init__(
        self,
        url: str,
        table: str,
        properties: Mapping[str, str] | None = None,
        num_partitions: int | None = None,
    ):
        self.url = url
        self.table = table
        self.properties = dict(properties or {})
        self.num_partitions = num_partitions

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        df = batch_df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        props = dict(self.properties)
        if self.num_partitions:
            props["numPartitions"] = str(self.num_partitions)
        df.write.jdbc(self.url, self.table, mode="append", properties=props)


class RowFileWriter:
    """``foreach`` writer: the rows of each (partition, epoch) in one Parquet file.

    Runs on the executors. Rows are written in chunks of ``chunk_rows``, so a
    task's memory is bounded, under a hidden name of the attempt; ``close``
    renames the file to that of its partition and epoch. A failed attempt leaves
    nothing that readers see, and a replayed epoch replaces its files. As with
    every ``foreach`` writer, that needs a replay with the same partitions.
    """

    def __init__(self, path: str, schema: str | StructType, chunk_rows: int = 50_000):
        self.path = path.rstrip("/")
        st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        self.schema_json = st.json()
        self.columns = st.fieldNames()
        self.chunk_rows = chunk_rows
        self._rows: list[tuple] = []
        self._out = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        filesystem, root = arrow_target(self.path)
        folder = f"{root}/epoch-{epoch_id:08d}"
        filesystem.create_dir(folder, recursive=True)
        self._rows, self._out = [], None
        self._hidden = f"{folder}/.part-{partition_id:05d}-{uuid.uuid4().hex}.tmp"
        self._name = f"{folder}/part-{partition_id:05d}.parquet"
        return True

    def process(self, row) -> None:
        self._rows.append(tuple(row[c] for c in self.columns))
        if len(self._rows) >= self.chunk_rows:
            self._flush()

    def _flush(self) -> None:
        if not self._rows:
            return
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(StructType.fromJson(json.loads(self.schema_json)))
        if self._out is None:
            self._out = pq.ParquetWriter(self._hidden, schema, filesystem=arrow_target(self.path)[0])
        cols = list(zip(*self._rows))
        self._out.write_table(pa.table({c: list(v) for c, v in zip(self.columns, cols)}, schema=schema))
        self._rows = []

    def close(self, error) -> None:
        if error is None:
            self._flush()
        if self._out is not None:
            self._out.close()
            if error is None:
                arrow_target(self.path)[0].move(self._hidden, self._name)
        self._rows, self._out = [], None


def read_rows(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path}/epoch-*")
