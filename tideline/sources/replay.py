"""File replay of Kafka-shaped records.

Stands in for a Kafka topic where no broker is available: rows of a table are
encoded as the Kafka source's envelope (``key, value`` BINARY plus topic,
partition, offset, timestamp) and staged as one folder per micro-batch under
the shared folder. ``read_replay`` streams them back with a fixed
``maxFilesPerTrigger`` equal to the files per staged batch, so every staged
batch becomes exactly one micro-batch and batch-dependent results (append
mode, late data, update changelogs) are reproducible.

Staging is a Spark write per batch. Each write filters the source by an
``event_id`` range first, so Parquet row-group statistics skip everything
outside the batch (``PushedFilters``) instead of rescanning the whole table per
batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE_DDL = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)

# Topic name and partition count of the original workload's producer.
DEFAULT_TOPIC = "shopping_transaction"
DEFAULT_PARTITIONS = 3


@dataclass(frozen=True)
class BatchRule:
    """Assigns each event to a micro-batch: ``clamp((id*B) div N + shift, 0, B-1)``.

    ``shifts`` maps ``id % modulus`` residues to a delay in batches (late rows).
    """

    batches: int = 4
    shifts: tuple[tuple[int, int], ...] = ()
    modulus: int = 50
    id_column: str = "event_id"

    @property
    def max_shift(self) -> int:
        return max((s for _, s in self.shifts), default=0)

    def duckdb_sql(self, n: int) -> str:
        """The batch number as a DuckDB SQL expression (for oracles)."""
        base = f"({self.id_column} * {self.batches}) // {n}"
        if self.shifts:
            cases = " ".join(f"WHEN {r} THEN {s}" for r, s in self.shifts)
            base = f"{base} + CASE {self.id_column} % {self.modulus} {cases} ELSE 0 END"
        return f"greatest(0, least({self.batches - 1}, {base}))"

    def column(self, n: int) -> Column:
        base = F.expr(f"({self.id_column} * {self.batches}) div {n}")
        if self.shifts:
            residue = F.col(self.id_column) % F.lit(self.modulus)
            shift = F.lit(0)
            for r, s in reversed(self.shifts):
                shift = F.when(residue == r, F.lit(s)).otherwise(shift)
            base = base + shift
        return F.greatest(F.lit(0).cast("long"), F.least(F.lit(self.batches - 1).cast("long"), base.cast("long")))

    def id_range(self, batch: int, n: int) -> tuple[int | None, int | None]:
        """[lo, hi) of ids that can land in ``batch`` (None = unbounded)."""
        first = max(0, batch - self.max_shift)
        lo = None if first == 0 else -(-first * n // self.batches)
        hi = None if batch >= self.batches - 1 else -(-(batch + 1) * n // self.batches)
        return lo, hi


EVEN = BatchRule()
# The late-data fixture delays ids with residue 7 by one batch and
# residue 8 by two batches (modulus 50).
LATE = BatchRule(shifts=((7, 1), (8, 2)))


def _epoch_decimal(ts: Column) -> Column:
    """Epoch seconds as DECIMAL(16,6): JSON text is exact and reproducible."""
    us = F.unix_micros(ts.cast("timestamp"))
    return (us.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(16,6)")


def transaction_json(value_mode: str = "clean") -> Column:
    """JSON text of the transaction record built from an ``events`` row.

    ``clean``: ``{"timestamp": epoch, "user_id", "item": event_type, "quantity": floor(value)}``.
    ``faulty``: the fixture of bad records, by ``event_id % 10``: 0 ISO-string
    timestamp and string user_id; 1 not JSON; 2 NULL; 3 no item; 4 user_id
    overflow and fractional quantity; 5 an extra field; 6-9 clean.
    """
    ts = _epoch_decimal(F.col("ts"))
    user = F.col("user_id").try_cast("bigint")
    item = F.col("event_type")
    qty = F.floor(F.col("value")).try_cast("int")
    clean = F.to_json(
        F.struct(ts.alias("timestamp"), user.alias("user_id"), item.alias("item"), qty.alias("quantity"))
    )
    if value_mode == "clean":
        return clean
    if value_mode != "faulty":
        raise ValueError(f"value_mode must be clean or faulty, got {value_mode!r}")
    r = F.col("event_id") % F.lit(10)
    iso = F.to_json(
        F.struct(
            F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'").alias("timestamp"),
            F.col("user_id").cast("string").alias("user_id"),
            item.alias("item"),
            qty.alias("quantity"),
        )
    )
    no_item = F.to_json(F.struct(ts.alias("timestamp"), user.alias("user_id"), qty.alias("quantity")))
    overflow = F.to_json(
        F.struct(
            ts.alias("timestamp"),
            F.lit(99999999999).alias("user_id"),
            item.alias("item"),
            F.lit(1.5).alias("quantity"),
        )
    )
    extra = F.to_json(
        F.struct(
            ts.alias("timestamp"),
            user.alias("user_id"),
            item.alias("item"),
            qty.alias("quantity"),
            F.lit("x").alias("note"),
        )
    )
    return (
        F.when(r == 0, iso)
        .when(r == 1, F.concat(F.lit("not json "), F.col("event_id").cast("string")))
        .when(r == 2, F.lit(None).cast("string"))
        .when(r == 3, no_item)
        .when(r == 4, overflow)
        .when(r == 5, extra)
        .otherwise(clean)
    )


def records_from_events(events: DataFrame) -> DataFrame:
    """The typed transaction records the topic carries, projected directly.

    Equal to decoding and parsing ``envelope_from_events(events)`` (clean
    records), without the JSON round trip, so Catalyst prunes the scan to the
    columns a batch query uses.
    """
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_id").cast("long").alias("offset"),
        (us / F.lit(1_000_000.0)).alias("timestamp"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.col("event_type").alias("item"),
        F.floor(F.col("value")).try_cast("int").alias("quantity"),
    )


# What the table's own JSON column ``props`` holds.
PROPS_DDL = "k BIGINT"


def envelope_from_events(
    events: DataFrame,
    topic: str = DEFAULT_TOPIC,
    partitions: int = DEFAULT_PARTITIONS,
    value_mode: str = "clean",
) -> DataFrame:
    """Kafka envelope for ``events`` rows (offset = event_id).

    ``clean`` / ``faulty``: NULL key, transaction JSON value. ``props``: the column ``props`` as it is, keyed by user.
    """
    key = F.lit(None).cast("string")
    if value_mode == "props":
        key, value = F.col("user_id").cast("string"), F.col("props")
    else:
        value = transaction_json(value_mode)
    return events.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("event_id") % F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


@dataclass
class StagedTopic:
    """A staged replay: ``path/batch-NNNNN/`` folders of ``files_per_batch`` files each."""

    path: str
    files_per_batch: int
    topic: str = DEFAULT_TOPIC
    batches: list[int] = field(default_factory=list)
    bytes: int = 0  # total size of the staged files, from the verification listing

    @property
    def glob(self) -> str:
        return f"{self.path}/batch-*"


def _batch_dir(path: str, i: int) -> str:
    return f"{path}/batch-{i:05d}"


def stage_batch(
    events: DataFrame,
    path: str,
    batch: int,
    rule: BatchRule,
    n: int,
    files_per_batch: int,
    topic: str = DEFAULT_TOPIC,
    partitions: int = DEFAULT_PARTITIONS,
    value_mode: str = "clean",
) -> None:
    """Write one micro-batch folder of exactly ``files_per_batch`` files."""
    lo, hi = rule.id_range(batch, n)
    idc = F.col(rule.id_column)
    src = events
    if lo is not None:
        # rows without an id are in the last batch
        src = src.where((idc >= lo) | idc.isNull() if batch == rule.batches - 1 else idc >= lo)
    if hi is not None:
        src = src.where(idc < hi)
    src = src.where(rule.column(n) == batch)
    env = envelope_from_events(src, topic, partitions, value_mode)
    # Round-robin gives every file the same share of the batch.
    env.repartition(files_per_batch).write.mode("overwrite").parquet(_batch_dir(path, batch))


def verify_staging(spark: SparkSession, staged: StagedTopic) -> None:
    """Check file counts and that batch i's files are all older than batch i+1's.

    Uses a metadata-only ``binaryFile`` listing (the content column is never read).
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(staged.glob)
        .select(
            F.regexp_extract("path", r"/batch-(\d+)/", 1).cast("int").alias("batch"),
            "modificationTime",
            "length",
        )
        .groupBy("batch")
        .agg(
            F.count("*").alias("files"),
            F.min("modificationTime").alias("first"),
            F.max("modificationTime").alias("last"),
            F.sum("length").alias("bytes"),
        )
        .orderBy("batch")
        .collect()
    )
    previous_last = None
    staged.bytes = sum(row["bytes"] for row in listing)
    for row in listing:
        if row["files"] != staged.files_per_batch:
            raise RuntimeError(
                f"staged batch {row['batch']} has {row['files']} files, expected "
                f"{staged.files_per_batch}: use fewer files per batch"
            )
        if previous_last is not None and row["first"] <= previous_last:
            raise RuntimeError(f"staged batch {row['batch']} is not newer than the one before")
        previous_last = row["last"]


def files_per_batch_for(spark: SparkSession, events: DataFrame, batches: int) -> int:
    """Files per staged batch: about one per scan split of the source
    (``spark.sql.files.maxPartitionBytes`` each), at least the default parallelism.

    The split count comes from Spark's own planning of the scan (file sizes are
    already known to it); no file list is shipped to Python.
    """
    splits = events.rdd.getNumPartitions()
    return max(spark.sparkContext.defaultParallelism, -(-splits // batches))


def stage_topic(
    spark: SparkSession,
    events: DataFrame,
    path: str,
    rule: BatchRule = EVEN,
    files_per_batch: int | None = None,
    batches: range | None = None,
    n: int | None = None,
    topic: str = DEFAULT_TOPIC,
    partitions: int = DEFAULT_PARTITIONS,
    value_mode: str = "clean",
) -> StagedTopic:
    """Stage ``batches`` (default: all of ``rule``) of ``events`` under ``path``.

    Batches are written one after another so that file modification times order
    them. Call again with later ``batches`` to add data to a running replay.
    """
    if n is None:
        n = events.count()
    k = files_per_batch or files_per_batch_for(spark, events, rule.batches)
    # Round-robin fills every file only if a batch has at least k rows.
    k = max(1, min(k, n // (2 * rule.batches)))
    todo = batches if batches is not None else range(rule.batches)
    staged = StagedTopic(path=path, files_per_batch=k, topic=topic)
    for i in todo:
        stage_batch(events, path, i, rule, n, k, topic, partitions, value_mode)
        staged.batches.append(i)
        _wait_for_newer_mtime(spark, _batch_dir(path, i))
    verify_staging(spark, staged)
    return staged


def _wait_for_newer_mtime(spark: SparkSession, folder: str) -> None:
    """Make the next batch's files strictly newer than this batch's.

    File systems with whole-second modification times (object stores) would
    give two quickly written batches the same time, and the file source orders
    by it; there, wait until the next second. Millisecond file systems need no
    wait.
    """
    import time

    stats = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .agg(
            F.max(F.unix_millis("modificationTime")).alias("last"),
            F.max(F.unix_millis("modificationTime") % 1000).alias("frac"),
        )
        .first()
    )
    if stats["last"] is None or stats["frac"] != 0:
        return
    wait = (stats["last"] + 1000) / 1000.0 - time.time()
    if wait > 0:
        time.sleep(wait + 0.05)


def read_replay(
    spark: SparkSession,
    staged: StagedTopic,
    subscribe: str | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Stream a staged topic back as the Kafka envelope.

    ``subscribe`` keeps one topic (names are trimmed). ``fail_on_data_loss=False`` skips staged files
    that disappeared before they were read (the file-source counterpart of the
    Kafka option) instead of failing the query.
    """
    reader = spark.readStream.schema(ENVELOPE_DDL).option("maxFilesPerTrigger", staged.files_per_batch)
    if not fail_on_data_loss:
        reader = reader.option("ignoreMissingFiles", "true")
    df = reader.parquet(staged.glob)
    return df if subscribe is None else df.where(F.col("topic") == F.lit(subscribe.strip()))
