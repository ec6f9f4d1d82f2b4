"""Catalogue queries on state, late rows, recovery, joins and chained windows, with their DuckDB SQL.

As in ``catalog``, streams replay the whole ``events`` table in four micro-batches and results
are read back as batch DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import (
    chained_window_agg,
    count_by,
    dedup_first,
    distinct_sketch,
    interval_join,
    merge_sketches,
    window_agg,
    with_watermark,
)
from tideline.plans.catalog import DELAY, TUMBLE, WINDOW_KEYS
from tideline.plans.common import (
    event_time,
    report,
    run_to_changelog,
    run_to_parquet,
    state_partitions,
    stream_transactions,
)
from tideline.plans.oracle import B_EVEN, B_LATE, ET, QTY, USER, _interval, _micros, _window_rows
from tideline.session import scratch_path, ship
from tideline.sources.replay import EVEN, LATE, BatchRule
from tideline.streaming import (
    AttemptLog,
    ChangelogWriter,
    DeliveryWriter,
    LateSplitter,
    OutboxSender,
    PartitionMergeWriter,
    checkpoint_offsets,
    compact_closed,
    open_windows,
    progress_frame,
    read_attempts,
    read_changelog,
    read_compacted,
    read_outbox,
    read_partitions,
    read_split,
    run,
    run_with_restarts,
)

# The periods of these queries.
DEDUP_EVERY = "6 hours"
DAY = "1 day"
JOIN_WITHIN = "6 hours"
TOP = 3


def _timed(spark: SparkSession, sf: str, rule: BatchRule = EVEN, keep: tuple[str, ...] = ("offset",)):
    parsed, st = stream_transactions(spark, sf, rule=rule, keep=keep)
    return with_watermark(event_time(parsed), "timestamp", DELAY), st


def dedup_watermark_first(spark: SparkSession, sf: str, rule: BatchRule = EVEN) -> DataFrame:
    """OP-57 across batches: the earliest row of each (user, item) in every six hours, once the watermark has passed them."""
    timed, st = _timed(spark, sf, rule)
    return report(run_to_parquet(dedup_first(timed, ["user_id", "item"], ["timestamp", "offset"], "timestamp", DEDUP_EVERY), st))


def state_rows_query(spark: SparkSession, sf: str) -> DataFrame:
    """OP-24/29: the windows that are still open after the last batch, with their partial counts, read from the state store."""
    timed, st = _timed(spark, sf, keep=())
    counts = window_agg(timed, "timestamp", TUMBLE, keys=["item"], aggs=[F.count("item").alias("item_count")])
    ck = scratch_path(spark, "checkpoint")
    run(counts, "parquet", "append", path=scratch_path(spark, "out"), checkpoint=ck, shuffle_partitions=state_partitions(spark, st))
    return report(open_windows(spark, ck, ["item"], {"item_count": "count"}))


def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """OP-28: what arrived in each batch, observed inside the plan, and how many of those rows came too late for their window."""
    timed, _ = _timed(spark, sf, rule=LATE)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    seen = timed.observe("arrived", F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("latest"))
    q = run(seen, "foreach_batch", "append", target=LateSplitter(out, ck, "timestamp", TUMBLE), checkpoint=ck)
    arrived = progress_frame(spark, q).where("num_input_rows > 0").select(
        "batch_id", F.col("observed.arrived")["rows"].cast("long").alias("rows")
    )
    fates = read_split(spark, out, _ddl(timed)).groupBy("batch_id").agg(
        F.count_if(F.col("fate") == "late").alias("late_rows"), F.count_if(F.col("fate") == "counted").alias("counted_rows")
    )
    return arrived.join(fates, "batch_id")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


class FailOnce:
    """``foreachBatch`` wrapper that fails after its target has written batch ``batch_id`` for the first time."""

    def __init__(self, target: Callable[[DataFrame, int], None], batch_id: int):
        self.target, self.batch_id, self.failed = target, batch_id, False

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        self.target(batch_df, batch_id)
        if batch_id == self.batch_id and not self.failed:
            self.failed = True
            raise RuntimeError(f"failure between write and commit of batch {batch_id}")


def replayed_batch(spark: SparkSession, sf: str) -> DataFrame:
    """OP-41/45: batch 1 fails after its write and before its commit; the restarted query gives it again, and the result is that of one run."""
    parsed, _ = stream_transactions(spark, sf, keep=())
    out, log, ck = (scratch_path(spark, k) for k in ("out", "attempts", "checkpoint"))
    per_batch = ChangelogWriter(out)
    target = AttemptLog(FailOnce(lambda df, n: per_batch(count_by(df, "item"), n), 1), log)
    run_with_restarts(lambda: run(parsed.select("item"), "foreach_batch", "append", target=target, checkpoint=ck), restarts=1)
    return read_changelog(spark, out).join(read_attempts(spark, log), "batch_id")


def upsert_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """OP-46: per-batch counts merged into a table by day; a batch rewrites its own days alone (``last_batch`` tells when a day was written last)."""
    parsed, _ = stream_transactions(spark, sf, keep=())
    out, ck = scratch_path(spark, "table"), scratch_path(spark, "checkpoint")
    dated = event_time(parsed).select(F.date_format("timestamp", "yyyy-MM-dd").alias("day"), "item")
    writer = PartitionMergeWriter(
        out, ck, ["day", "item"], "day", {"count": "target.count + source.count"},
        {"day": "source.day", "item": "source.item", "count": "source.count"},
    )
    run(dated, "foreach_batch", "append", target=lambda df, n: writer(count_by(df, "day", "item"), n), checkpoint=ck)
    return read_partitions(spark, out)


def distinct_users_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """OP-23: hourly sketches of the users of an item, stored once, and from them alone the distinct users by day and in all.

    Up to 3,072 users a sketch is in practice exact, and so are the unions here; beyond, its standard error is 0.6 %.
    """
    timed, st = _timed(spark, sf, keep=())
    hourly = distinct_sketch(timed, [F.window("timestamp", TUMBLE).alias("window"), "item"], "user_id")
    stored = hourly.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "item", "sketch")
    out = scratch_path(spark, "out")
    run(stored, "parquet", "append", path=out, partition_by=["day"], checkpoint=scratch_path(spark, "checkpoint"),
        shuffle_partitions=state_partitions(spark, st))
    sketches = spark.read.schema("item STRING, sketch BINARY, day STRING").parquet(out)
    daily = merge_sketches(sketches, ["day", "item"], "distinct_users")
    total = merge_sketches(sketches, ["item"], "distinct_users").withColumn("day", F.lit(None).cast("string"))
    return daily.unionByName(total)


def daily_peak(spark: SparkSession, sf: str) -> DataFrame:
    """§2.7: hourly counts and, from them in the same query, each day's highest hour."""
    timed, st = _timed(spark, sf, keep=())
    peaks = chained_window_agg(
        timed, "timestamp", TUMBLE, DAY, ["item"], [F.count("item").alias("item_count")],
        [F.max("item_count").alias("peak"), F.count(F.lit(1)).alias("hours")], ntz=True,
    )
    return run_to_parquet(peaks, st)


def _click_purchase(spark: SparkSession, sf: str, how: str) -> DataFrame:
    clicks, st = _timed(spark, sf)
    purchases, _ = _timed(spark, sf)
    side = lambda df, item: df.where(F.col("item") == item).select("user_id", "timestamp", "offset")
    joined = interval_join(side(clicks, "click"), side(purchases, "purchase"), ["user_id"], "timestamp", "timestamp", JOIN_WITHIN, how, "purchase_")
    return report(run_to_parquet(joined.drop("purchase_user_id"), st))


def join_click_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """§2.4: each purchase with the clicks of the same user up to six hours before it (two streams, state bounded by time)."""
    return _click_purchase(spark, sf, "inner")


def join_click_purchase_left(spark: SparkSession, sf: str) -> DataFrame:
    """§2.4: the same with the clicks that no purchase followed, emitted when the watermark rules one out."""
    return _click_purchase(spark, sf, "left_outer")


def top_items_live(spark: SparkSession, sf: str) -> DataFrame:
    """§2.6: the items with the highest running counts after every batch (complete mode with order and limit; the limit is the report)."""
    parsed, st = stream_transactions(spark, sf, keep=())
    top = count_by(parsed.select("item"), "item").orderBy(F.desc("count"), "item").limit(TOP)
    return run_to_changelog(top, st, "complete")


def tumbling_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """OP-25 as a table that does not grow with its batches: the days that the watermark has closed are compacted."""
    timed, st = _timed(spark, sf, keep=())
    counts = window_agg(timed, "timestamp", TUMBLE, keys=["item"], aggs=[F.count("item").alias("item_count")], ntz=True)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(counts.withColumn("day", F.date_format("start", "yyyy-MM-dd")), "foreach_batch", "update",
        target=ChangelogWriter(out, partition_by=["day"]), checkpoint=ck, shuffle_partitions=state_partitions(spark, st))
    watermark = checkpoint_offsets(spark, ck).agg(F.max("watermark_ms")).select(
        F.date_format(F.timestamp_millis("max(watermark_ms)"), "yyyy-MM-dd")
    )
    compact_closed(spark, out, WINDOW_KEYS, "day", before=watermark.first()[0])
    return read_compacted(spark, out, WINDOW_KEYS, "day")


class _LostReply(OutboxSender):
    """A receiver that takes every chunk, but whose first reply is lost: the sender has to send again."""

    def send(self, key: str, rows: pa.RecordBatch, attempt: int) -> None:
        super().send(key, rows, attempt)
        if attempt == 1:
            raise ConnectionError("no reply")


def outbox_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """OP-59: rows sent from the executors, every chunk twice as its first reply is lost; the receiver holds each row once."""
    ship(spark)
    parsed, st = stream_transactions(spark, sf)
    out = scratch_path(spark, "outbox")
    writer = DeliveryWriter(_LostReply(out), scratch_path(spark, "receipts"), ["offset"], partitions=st.files_per_batch)
    run(parsed.select("offset", "user_id", "item"), "foreach_batch", "append", target=writer, checkpoint=scratch_path(spark, "checkpoint"))
    return read_outbox(spark, out).select("offset", "user_id", "item", "attempt")


QUERIES = {
    "dedup_watermark_first": dedup_watermark_first,
    "state_rows": state_rows_query,
    "late_rows": late_rows,
    "replayed_batch": replayed_batch,
    "upsert_by_day": upsert_by_day,
    "distinct_users_rollup": distinct_users_rollup,
    "daily_peak": daily_peak,
    "join_click_purchase": join_click_purchase,
    "join_click_purchase_left": join_click_purchase_left,
    "top_items_live": top_items_live,
    "outbox_delivery": outbox_delivery,
    "tumbling_compacted": tumbling_compacted,
}

_LAST = f"(SELECT max({ET}) - {_interval(DELAY)} FROM events)"


def _floor(time: str, size: str) -> str:
    return f"make_timestamp((epoch_us({time}) // {_micros(size)}) * {_micros(size)})"


_COUNTS = f"""SELECT start, "end", item, count(item) AS item_count
    FROM ({_window_rows(TUMBLE, None, 'event_type AS item')}) w GROUP BY ALL"""

_PAIRS = f"""c AS (SELECT event_id AS "offset", {USER} AS user_id, {ET} AS timestamp FROM events WHERE event_type = 'click'),
p AS (SELECT event_id AS purchase_offset, {USER} AS user_id, {ET} AS purchase_timestamp FROM events WHERE event_type = 'purchase'),
j AS (SELECT c.*, p.purchase_offset, p.purchase_timestamp FROM c JOIN p
      ON c.user_id = p.user_id AND purchase_timestamp BETWEEN c.timestamp AND c.timestamp + {_interval(JOIN_WITHIN)})"""

ORACLES = {
    "dedup_watermark_first": f"""
        SELECT "offset", timestamp, user_id, item, quantity FROM (
          SELECT event_id AS "offset", {ET} AS timestamp, {USER} AS user_id, event_type AS item, {QTY} AS quantity,
                 {_floor(ET, DEDUP_EVERY)} + {_interval(DEDUP_EVERY)} AS until,
                 row_number() OVER (PARTITION BY {_floor(ET, DEDUP_EVERY)}, {USER}, event_type ORDER BY {ET}, event_id) AS place
          FROM events)
        WHERE place = 1 AND until <= {_LAST}""",
    "state_rows": f'SELECT * FROM ({_COUNTS}) WHERE "end" > {_LAST}',
    "late_rows": f"""
        WITH r AS (SELECT {ET} AS et, {B_LATE} AS b FROM events),
        m AS (SELECT b, max(et) AS latest FROM r GROUP BY b),
        l AS (SELECT x.b, (SELECT max(y.latest) - {_interval(DELAY)} FROM m y WHERE y.b <= x.b - 2) AS late FROM m x),
        t AS (SELECT b, coalesce({_floor('et', TUMBLE)} + {_interval(TUMBLE)} <= late, false) AS is_late FROM r JOIN l USING (b))
        SELECT CAST(b AS BIGINT) AS batch_id, count(*) AS rows, count(*) FILTER (is_late) AS late_rows,
               count(*) FILTER (NOT is_late) AS counted_rows
        FROM t GROUP BY b""",
    "replayed_batch": f"""
        SELECT CAST({B_EVEN} AS BIGINT) AS batch_id, event_type AS item, count(*) AS count,
               CAST(CASE WHEN {B_EVEN} = 1 THEN 2 ELSE 1 END AS BIGINT) AS attempts
        FROM events GROUP BY ALL""",
    "upsert_by_day": f"""
        WITH d AS (SELECT strftime({ET}, '%Y-%m-%d') AS day, event_type AS item, {B_EVEN} AS b FROM events),
        l AS (SELECT day, CAST(max(b) AS BIGINT) AS last_batch FROM d GROUP BY day)
        SELECT day, item, count(*) AS count, last_batch FROM d JOIN l USING (day) GROUP BY day, item, last_batch""",
    "distinct_users_rollup": f"""
        WITH d AS (SELECT strftime({ET}, '%Y-%m-%d') AS day, event_type AS item, user_id FROM events
                   WHERE {_floor(ET, TUMBLE)} + {_interval(TUMBLE)} <= {_LAST})
        SELECT day, item, count(DISTINCT user_id) AS distinct_users FROM d GROUP BY GROUPING SETS ((day, item), (item))""",
    "daily_peak": f"""
        SELECT start, "end", item, max(item_count) AS peak, count(*) AS hours FROM (
          SELECT {_floor('start', DAY)} AS start, {_floor('start', DAY)} + {_interval(DAY)} AS "end", item, item_count FROM ({_COUNTS}))
        GROUP BY ALL HAVING "end" <= {_LAST}""",
    "join_click_purchase": f"WITH {_PAIRS} SELECT * FROM j",
    "join_click_purchase_left": f"""
        WITH {_PAIRS},
        w AS (SELECT least((SELECT max(timestamp) FROM c), (SELECT max(purchase_timestamp) FROM p)) - {_interval(DELAY)} AS mark)
        SELECT * FROM j UNION ALL
        SELECT c.*, NULL, NULL FROM c, w
        WHERE c."offset" NOT IN (SELECT "offset" FROM j) AND c.timestamp + {_interval(JOIN_WITHIN)} < mark""",
    "top_items_live": f"""
        WITH e AS (SELECT {B_EVEN} AS b, event_type AS item FROM events),
        n AS (SELECT x.b, e.item, count(*) AS count FROM (SELECT DISTINCT b FROM e) x JOIN e ON e.b <= x.b GROUP BY ALL)
        SELECT CAST(b AS BIGINT) AS batch_id, item, count FROM n
        QUALIFY row_number() OVER (PARTITION BY b ORDER BY count DESC, item) <= {TOP}""",
    "tumbling_compacted": f"""SELECT *, date_trunc('day', start) < date_trunc('day', {_LAST}) AS compacted FROM ({_COUNTS})""",
    "outbox_delivery": f"""SELECT event_id AS "offset", {USER} AS user_id, event_type AS item, 2::INTEGER AS attempt FROM events""",
}
