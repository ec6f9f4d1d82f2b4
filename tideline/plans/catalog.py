"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Streaming queries replay the whole ``events`` table as a Kafka-shaped topic in
four micro-batches (``availableNow``), run the operator into a sink, and
return the sink's content as a batch DataFrame. Event times are reported as
TIMESTAMP_NTZ (UTC wall clock).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import decode, parse_json, to_kv_json
from tideline.operators import (
    count_by,
    dedup,
    dedup_within_watermark,
    distinct_count,
    with_reasons,
    window_agg,
    with_watermark,
)
from tideline.plans.common import (
    batch_transactions,
    event_time,
    events,
    report,
    run_complete,
    run_to_changelog,
    run_to_parquet,
    staged,
    state_partitions,
    stream_transactions,
)
from tideline.session import pin_utc, scratch_path, ship
from tideline.sources import table_scan, table_stream
from tideline.sources.replay import (
    DEFAULT_TOPIC,
    EVEN,
    LATE,
    PROPS_DDL,
    read_replay,
    stage_topic,
)
from tideline.streaming import (
    ChangelogWriter,
    MergeWriter,
    RowFileWriter,
    TopicWriter,
    Trigger,
    checkpoint_offsets,
    read_changelog,
    read_history,
    read_merged,
    read_topic,
    run,
)
from tideline.streaming.sinks import read_latest_batch, read_latest_rows, read_rows

Query = Callable[[SparkSession, str], DataFrame]

# Window sizes, slides and watermark delays of the catalogue
# (the original workload uses seconds; events here are minutes apart).
TUMBLE = "1 hour"
SLIDE_SIZE, SLIDE_STEP = "20 minutes", "10 minutes"
SUM_SIZE, SUM_STEP = "15 minutes", "5 minutes"
DELAY = "10 minutes"



# -- sources and decoding ------------------------------------------------------


def kafka_envelope_scan(spark: SparkSession, sf: str) -> DataFrame:
    """OP-01/02: the table itself as a stream in the envelope's shape: key, value, topic (its event type), offset, timestamp."""
    pin_utc(spark)
    rows = table_stream(spark, f"{sf}/events.parquet").select(
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.col("event_type").alias("topic"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    out = scratch_path(spark, "out")
    run(rows, "parquet", "append", path=out, checkpoint=scratch_path(spark, "checkpoint"))
    return report(spark.read.parquet(out))


def _raw(spark: SparkSession, sf: str):
    st = staged(spark, sf)
    return read_replay(spark, st, subscribe=DEFAULT_TOPIC + " "), st


def decode_kv(spark: SparkSession, sf: str) -> DataFrame:
    """OP-07: ``CAST(key AS STRING), CAST(value AS STRING)``."""
    stream, st = _raw(spark, sf)
    return run_to_parquet(decode(stream, key=True, keep=["offset"]), st)


def decode_messages(spark: SparkSession, sf: str) -> DataFrame:
    """OP-07/13 with keys: the JSON that the table itself holds (``props``), keyed by user."""
    st = staged(spark, sf, EVEN, "props")
    parsed = parse_json(decode(read_replay(spark, st), key=True, keep=["offset"]), PROPS_DDL, keep=["key", "offset"])
    return run_to_parquet(parsed, st)


def start_earliest(spark: SparkSession, sf: str) -> DataFrame:
    """OP-03 earliest: a first start reads the whole backlog of the topic: every record, by its position."""
    stream, st = _raw(spark, sf)
    return run_to_parquet(stream.select("partition", "offset"), st)


def start_latest(spark: SparkSession, sf: str) -> DataFrame:
    """OP-03 latest: only records staged after the first start (the last batch).

    The first start reads no column of the backlog and drops it; its checkpoint is where the query then goes on.
    """
    ev = events(spark, sf)
    n = ev.count()
    path, ck, out = (scratch_path(spark, k) for k in ("stage", "checkpoint", "out"))
    st = stage_topic(spark, ev, path, EVEN, batches=range(0, 3), n=n)
    run(read_replay(spark, st).select(F.lit(1)), "noop", checkpoint=ck, trigger=Trigger(once=True))
    st = stage_topic(spark, ev, path, EVEN, batches=range(3, 4), n=n, files_per_batch=st.files_per_batch)
    stream = read_replay(spark, st, subscribe=DEFAULT_TOPIC)
    run(stream.select("partition", "offset"), "foreach_batch", "append", target=ChangelogWriter(out), checkpoint=ck)
    return read_changelog(spark, out).drop("batch_id")


def table_scan_query(spark: SparkSession, sf: str) -> DataFrame:
    """OP-06: batch table scan."""
    return table_scan(spark, f"{sf}/events.parquet")


# -- parsing and event time ----------------------------------------------------


def parse_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """OP-08/13: from_json with the declared DDL, ``data.*``."""
    parsed, st = stream_transactions(spark, sf)
    return run_to_parquet(parsed, st)


def event_time_query(spark: SparkSession, sf: str) -> DataFrame:
    """OP-10/14: epoch-seconds DOUBLE -> TIMESTAMP (fraction dropped)."""
    parsed, st = stream_transactions(spark, sf)
    return report(run_to_parquet(event_time(parsed), st))


def parse_bad_types(spark: SparkSession, sf: str) -> DataFrame:
    """OP-13/31: PERMISSIVE parsing of the bad-record fixture (NULL patterns)."""
    parsed, st = stream_transactions(spark, sf, value_mode="faulty")
    return report(run_to_parquet(event_time(parsed), st))


# -- item counts by many routes --------------------------------------------------


def item_counts(spark: SparkSession, sf: str) -> DataFrame:
    """OP-18 on a batch frame: the same transform as the streams below."""
    return count_by(batch_transactions(spark, sf), "item")


def _counts_stream(spark: SparkSession, sf: str):
    parsed, st = stream_transactions(spark, sf, keep=())
    return count_by(parsed.select("item"), "item"), st


def null_item_counts(spark: SparkSession, sf: str) -> DataFrame:
    """OP-18 vs OP-19 on the bad-record fixture: ``count(*)`` counts rows of the
    NULL-item group, ``count(item)`` does not."""
    parsed, st = stream_transactions(spark, sf, value_mode="faulty", keep=())
    counts = parsed.groupBy("item").agg(
        F.count(F.lit(1)).alias("rows"), F.count("item").alias("item_count")
    )
    return run_complete(counts, st)


def mode_complete(spark: SparkSession, sf: str) -> DataFrame:
    """OP-37: complete mode; the last batch holds the whole result."""
    counts, st = _counts_stream(spark, sf)
    return run_complete(counts, st, evidence=True)


def trigger_once(spark: SparkSession, sf: str) -> DataFrame:
    """OP-33: one batch with everything available."""
    counts, st = _counts_stream(spark, sf)
    return run_complete(counts, st, evidence=True, trigger=Trigger(once=True))


def trigger_default(spark: SparkSession, sf: str) -> DataFrame:
    """OP-32: default trigger, drained with processAllAvailable then stopped."""
    counts, st = _counts_stream(spark, sf)
    return run_complete(counts, st, evidence=True, trigger=Trigger())


def trigger_interval(spark: SparkSession, sf: str) -> DataFrame:
    """OP-35: fixed-interval trigger."""
    counts, st = _counts_stream(spark, sf)
    return run_complete(counts, st, evidence=True, trigger=Trigger(processing_time="1 second"))


def memory_table_sql(spark: SparkSession, sf: str) -> DataFrame:
    """OP-48/52: complete-mode memory table queried with SQL (small results only)."""
    counts, st = _counts_stream(spark, sf)
    name = "item_counts_" + scratch_path(spark, "x").rsplit("/", 1)[1][:12]
    run(counts, "memory", "complete", name=name, shuffle_partitions=state_partitions(spark, st))
    return spark.sql(f"SELECT item, `count` FROM {name}")


def foreach_batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    """OP-45: per-batch counts inside foreachBatch, folded into totals."""
    parsed, st = stream_transactions(spark, sf, keep=())
    out = scratch_path(spark, "out")

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        (
            count_by(batch_df, "item")
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .parquet(f"{out}/batch-{batch_id:08d}")
        )

    run(parsed.select("item"), "foreach_batch", "append", target=per_batch,
        checkpoint=scratch_path(spark, "checkpoint"))
    totals = spark.read.parquet(f"{out}/batch-*")
    return totals.groupBy("item").agg(F.sum("count").alias("count"), F.count_distinct("batch_id").alias("batches"))


def checkpoint_resume(spark: SparkSession, sf: str) -> DataFrame:
    """OP-41: stop after two batches, add the rest, resume on the same checkpoint.

    ``rows_after`` is the number of rows that the resumed query read.
    """
    ev = events(spark, sf)
    n = ev.count()
    path, ck, out = (scratch_path(spark, k) for k in ("stage", "checkpoint", "out"))
    parts = None
    for batches in (range(0, 2), range(2, 4)):
        st = stage_topic(spark, ev, path, EVEN, batches=batches, n=n)
        parts = parts or state_partitions(spark, st)
        parsed = decode(read_replay(spark, st, subscribe=DEFAULT_TOPIC), key=False)
        counts = count_by(parse_json(parsed).select("item"), "item")
        q = run(counts, "foreach_batch", "complete", target=ChangelogWriter(out), checkpoint=ck,
                shuffle_partitions=parts)
    rows = sum(p["numInputRows"] for p in q.recentProgress)
    return read_latest_batch(spark, out).withColumn("rows_after", F.lit(rows).cast("long"))


# -- update mode, Kafka records, merge -----------------------------------------


def mode_update_changelog(spark: SparkSession, sf: str) -> DataFrame:
    """OP-38: update mode emits the keys touched per batch with running totals."""
    counts, st = _counts_stream(spark, sf)
    return run_to_changelog(counts, st, "update")


def kafka_sink_records(spark: SparkSession, sf: str) -> DataFrame:
    """OP-15/16/17/49: ``key = item, value = to_json(struct(item, count))``, update mode."""
    counts, st = _counts_stream(spark, sf)
    records = to_kv_json(counts, "item", ["item", "count"])
    out = scratch_path(spark, "topic")
    run(records, "foreach_batch", "update", target=TopicWriter(out, "shopping_items_aggregates"),
        checkpoint=scratch_path(spark, "checkpoint"), shuffle_partitions=state_partitions(spark, st))
    return read_topic(spark, out).select("key", "value")


def _merge_run(spark: SparkSession, sf: str, recipe: str) -> DataFrame:
    out, ck = scratch_path(spark, "table"), scratch_path(spark, "checkpoint")
    update = {"count": "source.count"} if recipe == "replace" else {"count": "target.count + source.count"}
    writer = MergeWriter(out, ck, ["item"], update, {"item": "source.item", "count": "source.count"})
    if recipe == "add_batch":
        parsed, st = stream_transactions(spark, sf, keep=())
        run(parsed.select("item"), "foreach_batch", "append", checkpoint=ck,
            target=lambda batch_df, batch_id: writer(count_by(batch_df, "item"), batch_id))
    else:
        counts, st = _counts_stream(spark, sf)
        run(counts, "foreach_batch", "update", target=writer, checkpoint=ck,
            shuffle_partitions=state_partitions(spark, st))
    return read_merged(spark, out)


def upsert_replace(spark: SparkSession, sf: str) -> DataFrame:
    """OP-46, replace recipe: update-mode running totals overwrite the stored count."""
    return _merge_run(spark, sf, "replace")


def upsert_add_batch(spark: SparkSession, sf: str) -> DataFrame:
    """OP-46, add recipe: stateless per-batch counts are added to the stored count."""
    return _merge_run(spark, sf, "add_batch")


def upsert_add_running(spark: SparkSession, sf: str) -> DataFrame:
    """OP-46 as originally written: running totals *added* (over-counts)."""
    return _merge_run(spark, sf, "add_running")


def table_history(spark: SparkSession, sf: str) -> DataFrame:
    """OP-53: what each batch's merge inserted and updated, as observed in the merge's own write and kept beside the table."""
    counts, st = _counts_stream(spark, sf)
    out, ck = scratch_path(spark, "table"), scratch_path(spark, "checkpoint")
    writer = MergeWriter(out, ck, ["item"], {"count": "source.count"}, {"item": "source.item", "count": "source.count"})
    run(counts, "foreach_batch", "update", target=writer, checkpoint=ck, shuffle_partitions=state_partitions(spark, st))
    return read_history(spark, out).withColumn("version", F.col("batch_id"))


def table_complete(spark: SparkSession, sf: str) -> DataFrame:
    """OP-51a: each batch's complete result replaces a catalogue table under the shared folder."""
    counts, st = _counts_stream(spark, sf)
    name = "item_totals_" + scratch_path(spark, "x").rsplit("/", 1)[1][:12]
    location = scratch_path(spark, "table")

    def replace(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").option("path", location).saveAsTable(name)

    run(counts, "foreach_batch", "complete", target=replace,
        checkpoint=scratch_path(spark, "checkpoint"), shuffle_partitions=state_partitions(spark, st))
    return spark.table(name)


# -- append-mode sinks -----------------------------------------------------------

SINK_COLUMNS = ["offset", "user_id", "item", "quantity"]
SINK_DDL = "offset BIGINT, user_id BIGINT, item STRING, quantity INT"


def mode_append(spark: SparkSession, sf: str) -> DataFrame:
    """OP-39: stateless append, each row once."""
    parsed, st = stream_transactions(spark, sf)
    return run_to_parquet(parsed.select(*SINK_COLUMNS), st)


def table_append(spark: SparkSession, sf: str) -> DataFrame:
    """OP-50: ``toTable`` into an external Parquet table under the shared folder."""
    parsed, st = stream_transactions(spark, sf)
    name = "parsed_" + scratch_path(spark, "x").rsplit("/", 1)[1][:12]
    location = scratch_path(spark, "table")
    spark.sql(f"CREATE TABLE {name} ({SINK_DDL}) USING parquet LOCATION '{location}'")
    run(parsed.select(*SINK_COLUMNS), "table", "append", target=name,
        checkpoint=scratch_path(spark, "checkpoint"))
    return spark.table(name)


def _file_sink(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    parsed, st = stream_transactions(spark, sf)
    out = scratch_path(spark, "out")
    run(parsed.select(*SINK_COLUMNS), fmt, "append", path=out, checkpoint=scratch_path(spark, "checkpoint"))
    return spark.read.schema(SINK_DDL).format(fmt).load(out)


def file_sink_json(spark: SparkSession, sf: str) -> DataFrame:
    """OP-54: JSON file sink."""
    return _file_sink(spark, sf, "json")


def file_sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    """OP-54: CSV file sink."""
    return _file_sink(spark, sf, "csv")


def file_sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """OP-54: Parquet file sink."""
    return _file_sink(spark, sf, "parquet")


def foreach_rows(spark: SparkSession, sf: str) -> DataFrame:
    """OP-55: row-level foreach writer (runs on the executors)."""
    ship(spark)
    parsed, st = stream_transactions(spark, sf)
    out = scratch_path(spark, "rows")
    run(parsed.select(*SINK_COLUMNS), "foreach", "append", target=RowFileWriter(out, SINK_DDL),
        checkpoint=scratch_path(spark, "checkpoint"))
    return read_rows(spark, out, SINK_DDL)


# -- windows, watermarks, late data --------------------------------------------


def _windowed(spark, sf, size, slide, aggs, rule=EVEN, delay=None):
    parsed, st = stream_transactions(spark, sf, rule=rule, keep=())
    timed = event_time(parsed)
    if delay:
        timed = with_watermark(timed, "timestamp", delay)
    return window_agg(timed, "timestamp", size, slide, keys=["item"], aggs=aggs, ntz=True), st


WINDOW_KEYS = ["start", "end", "item"]


def window_table(df: DataFrame, st) -> DataFrame:
    """A watermarked window aggregate in update mode: each batch writes the windows that it changed.

    State ends with the watermark, a batch writes its own changes alone, and readers take each
    window's newest row.
    """
    spark = df.sparkSession
    out = scratch_path(spark, "out")
    run(df, "foreach_batch", "update", target=ChangelogWriter(out), checkpoint=scratch_path(spark, "checkpoint"),
        shuffle_partitions=state_partitions(spark, st))
    return read_latest_rows(spark, out, WINDOW_KEYS)


def _by_day(df: DataFrame, st) -> DataFrame:
    """A watermarked window aggregate in append mode: closed windows once, in folders by day."""
    spark = df.sparkSession
    out = scratch_path(spark, "out")
    run(df.withColumn("day", F.to_date("start")), "parquet", "append", path=out, partition_by=["day"],
        checkpoint=scratch_path(spark, "checkpoint"), shuffle_partitions=state_partitions(spark, st))
    return spark.read.parquet(out).drop("day")


def tumbling_count(spark: SparkSession, sf: str) -> DataFrame:
    """OP-09/19/20/25: tumbling window count of items."""
    df, st = _windowed(spark, sf, TUMBLE, None, [F.count("item").alias("item_count")], delay=DELAY)
    return window_table(df, st)


def tumbling_complete(spark: SparkSession, sf: str) -> DataFrame:
    """OP-25/37: the same counts in complete mode (every window is held and written each time)."""
    df, st = _windowed(spark, sf, TUMBLE, None, [F.count("item").alias("item_count")])
    return run_complete(df, st)


def tumbling_avg(spark: SparkSession, sf: str) -> DataFrame:
    """OP-21: several averages per tumbling window."""
    df, st = _windowed(spark, sf, TUMBLE, None, delay=DELAY,
                       aggs=[F.avg(c).alias(f"avg_{c}") for c in ("quantity", "user_id")])
    return window_table(df, st)


def sliding_count(spark: SparkSession, sf: str) -> DataFrame:
    """OP-26: sliding window count (each row in size/slide windows)."""
    df, st = _windowed(spark, sf, SLIDE_SIZE, SLIDE_STEP, [F.count("item").alias("item_count")], delay=DELAY)
    return window_table(df, st)


def sliding_sum(spark: SparkSession, sf: str) -> DataFrame:
    """OP-22: sum of quantity over a sliding window."""
    df, st = _windowed(spark, sf, SUM_SIZE, SUM_STEP, [F.sum("quantity").alias("sum_quantity")], delay=DELAY)
    return window_table(df, st)


def tumbling_append(spark: SparkSession, sf: str) -> DataFrame:
    """OP-25/27/50: closed tumbling windows, appended by day."""
    return _by_day(*_windowed(spark, sf, TUMBLE, None, [F.count("item").alias("item_count")], delay=DELAY))


def sliding_append(spark: SparkSession, sf: str) -> DataFrame:
    """OP-26/27/50: closed sliding windows, appended by day."""
    return _by_day(*_windowed(spark, sf, SLIDE_SIZE, SLIDE_STEP, [F.count("item").alias("item_count")], delay=DELAY))


def null_item_windows(spark: SparkSession, sf: str) -> DataFrame:
    """OP-20/31: windows of the bad-record fixture, whose items and times may be NULL (no time: no window)."""
    parsed, st = stream_transactions(spark, sf, value_mode="faulty", keep=())
    timed = with_watermark(event_time(parsed), "timestamp", DELAY)
    aggs = [F.count(F.lit(1)).alias("rows"), F.count("item").alias("item_count")]
    return window_table(window_agg(timed, "timestamp", TUMBLE, None, keys=["item"], aggs=aggs, ntz=True), st)


def memory_append(spark: SparkSession, sf: str) -> DataFrame:
    """OP-27/39/48: watermark + append into a memory table, read with SQL (small results only)."""
    df, st = _windowed(spark, sf, TUMBLE, None, [F.count("item").alias("item_count")], delay=DELAY)
    name = "closed_windows_" + scratch_path(spark, "x").rsplit("/", 1)[1][:12]
    run(df, "memory", "append", name=name, shuffle_partitions=state_partitions(spark, st))
    return spark.sql(f"SELECT * FROM {name}")


def watermark_append(spark: SparkSession, sf: str) -> DataFrame:
    """OP-27/30: watermark + append: each closed window emitted once."""
    df, st = _windowed(spark, sf, TUMBLE, None, [F.count("item").alias("item_count")], delay=DELAY)
    return run_to_parquet(df, st)


def watermark_append_rocksdb(spark: SparkSession, sf: str) -> DataFrame:
    """OP-44: the same query on the RocksDB state store, with the store that the checkpoint names."""
    df, st = _windowed(spark, sf, TUMBLE, None, [F.count("item").alias("item_count")], delay=DELAY)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(df, "parquet", "append", path=out, checkpoint=ck, state_store="rocksdb",
        shuffle_partitions=state_partitions(spark, st))
    provider = F.col("conf")["spark.sql.streaming.stateStore.providerClass"]
    stores = checkpoint_offsets(spark, ck).select(F.substring_index(provider, ".", -1).alias("store")).distinct()
    return spark.read.parquet(out).join(F.broadcast(stores))


def late_data_append(spark: SparkSession, sf: str) -> DataFrame:
    """OP-28/29/30: late rows; one batch late is counted, two batches late dropped."""
    df, st = _windowed(spark, sf, TUMBLE, None, [F.count("item").alias("item_count")],
                       rule=LATE, delay=DELAY)
    return run_to_parquet(df, st)


# -- distinct, dedup, validation ----------------------------------------------------


def distinct_users_batch(spark: SparkSession, sf: str) -> DataFrame:
    """OP-23: exact distinct users per item (batch)."""
    return distinct_count(batch_transactions(spark, sf), ["item"], "user_id", "distinct_users")


def approx_users_stream(spark: SparkSession, sf: str) -> DataFrame:
    """OP-23 on a stream: is the HyperLogLog++ estimate (rsd 0.05) within 3 rsd of the exact count?"""
    parsed, st = stream_transactions(spark, sf, keep=())
    est = run_complete(distinct_count(parsed, ["item"], "user_id", "estimate"), st)
    exact = distinct_count(batch_transactions(spark, sf), ["item"], "user_id", "exact")
    off = F.abs(F.col("estimate") - F.col("exact"))
    return est.join(exact, "item").select("item", "exact", (off <= 3 * 0.05 * F.col("exact")).alias("within_3_rsd"))


def dedup_batch(spark: SparkSession, sf: str) -> DataFrame:
    """OP-57: per-batch de-duplication inside foreachBatch (earliest row per key kept)."""
    parsed, st = stream_transactions(spark, sf)
    out = scratch_path(spark, "out")

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        (
            dedup(batch_df, ["user_id", "item"], order_by=["timestamp", "offset"])
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .parquet(f"{out}/batch-{batch_id:08d}")
        )

    run(event_time(parsed), "foreach_batch", "append", target=per_batch,
        checkpoint=scratch_path(spark, "checkpoint"))
    return report(spark.read.parquet(f"{out}/batch-*"))


def dedup_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """OP-57 across batches: dropDuplicatesWithinWatermark on (user_id, item)."""
    parsed, st = stream_transactions(spark, sf)
    deduped = dedup_within_watermark(event_time(parsed), ["user_id", "item"], "timestamp", DELAY)
    return report(run_to_parquet(deduped, st))


def _rules():
    return {
        "json": F.col("_corrupt_record").isNull(),
        "timestamp": F.col("timestamp").isNotNull(),
        "user": F.col("user_id").isNotNull(),
        "item": F.col("item").isNotNull(),
        "quantity": F.col("quantity") > 0,
    }


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    """The faulty topic, good and bad rows from one stream whose file sink is partitioned by ``valid``."""
    parsed, _ = stream_transactions(spark, sf, value_mode="faulty", corrupt_column="_corrupt_record")
    tagged = with_reasons(event_time(parsed), _rules())
    out = scratch_path(spark, "out")
    run(tagged, "parquet", "append", path=out, checkpoint=scratch_path(spark, "checkpoint"),
        partition_by=["valid"])
    return report(spark.read.schema(tagged.schema).parquet(out))


def validate_good(spark: SparkSession, sf: str) -> DataFrame:
    """OP-58: rows passing every rule."""
    return _validated(spark, sf).where("valid").drop("valid", "reasons", "_corrupt_record")


def validate_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """OP-58: rows failing a rule, with the failed rules."""
    return _validated(spark, sf).where("not valid").select("offset", "reasons")


def checkpoint_offsets_query(spark: SparkSession, sf: str) -> DataFrame:
    """OP-42: the offsets log of a watermarked query as rows."""
    df, st = _windowed(spark, sf, TUMBLE, None, [F.count("item").alias("item_count")], delay=DELAY)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(df, "parquet", "append", path=out, checkpoint=ck, shuffle_partitions=state_partitions(spark, st))
    return checkpoint_offsets(spark, ck).select(
        "batch_id", "source_index", "log_offset", "watermark_ms", "committed"
    )


QUERIES: dict[str, Query] = {
    "kafka_envelope_scan": kafka_envelope_scan,
    "decode_kv": decode_kv,
    "decode_messages": decode_messages,
    "start_earliest": start_earliest,
    "start_latest": start_latest,
    "table_scan": table_scan_query,
    "parse_transactions": parse_transactions,
    "event_time": event_time_query,
    "parse_bad_types": parse_bad_types,
    "item_counts": item_counts,
    "null_item_counts": null_item_counts,
    "mode_complete": mode_complete,
    "trigger_once": trigger_once,
    "trigger_default": trigger_default,
    "trigger_interval": trigger_interval,
    "memory_table_sql": memory_table_sql,
    "foreach_batch_counts": foreach_batch_counts,
    "checkpoint_resume": checkpoint_resume,
    "mode_update_changelog": mode_update_changelog,
    "kafka_sink_records": kafka_sink_records,
    "upsert_replace": upsert_replace,
    "upsert_add_batch": upsert_add_batch,
    "upsert_add_running": upsert_add_running,
    "table_history": table_history,
    "table_complete": table_complete,
    "mode_append": mode_append,
    "table_append": table_append,
    "file_sink_json": file_sink_json,
    "file_sink_csv": file_sink_csv,
    "file_sink_parquet": file_sink_parquet,
    "foreach_rows": foreach_rows,
    "tumbling_count": tumbling_count,
    "tumbling_complete": tumbling_complete,
    "tumbling_avg": tumbling_avg,
    "sliding_count": sliding_count,
    "sliding_sum": sliding_sum,
    "tumbling_append": tumbling_append,
    "sliding_append": sliding_append,
    "null_item_windows": null_item_windows,
    "memory_append": memory_append,
    "watermark_append": watermark_append,
    "watermark_append_rocksdb": watermark_append_rocksdb,
    "late_data_append": late_data_append,
    "distinct_users_batch": distinct_users_batch,
    "approx_users_stream": approx_users_stream,
    "dedup_batch": dedup_batch,
    "dedup_watermark": dedup_watermark,
    "validate_good": validate_good,
    "validate_quarantine": validate_quarantine,
    "checkpoint_offsets": checkpoint_offsets_query,
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Kafka JSON -> typed columns -> watermarked 1-hour tumbling count -> append sink."""
    return watermark_append(spark, sf)
