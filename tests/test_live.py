"""State as rows, late rows, recovery, partition merge, delivery, joins and chained windows."""

import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF_SMALL
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
from tideline.plans import ORACLES, QUERIES, live
from tideline.plans.common import batch_transactions, event_time, stream_transactions
from tideline.session import scratch_path
from tideline.sources import table_stream
from tideline.sources.replay import LATE, BatchRule
from tideline.streaming import (
    AttemptLog,
    ChangelogWriter,
    DeliveryWriter,
    LateSplitter,
    OutboxSender,
    PartitionMergeWriter,
    compact_closed,
    hash_part,
    open_windows,
    read_attempts,
    read_changelog,
    read_compacted,
    read_history,
    read_outbox,
    read_partitions,
    read_split,
    run,
    run_with_restarts,
    state_metadata,
    state_rows,
)
from tideline.streaming.files import list_names
from tideline.streaming.late import late_watermark_ms


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _timed(spark, rule=BatchRule(), keep=("offset",)):
    parsed, st = stream_transactions(spark, SF_SMALL, rule=rule, keep=keep)
    return with_watermark(event_time(parsed), "timestamp", "10 minutes"), st


# --- de-duplication with a chosen row --------------------------------------------------------


@pytest.mark.parametrize("batches", [1, 2, 4, 7])
def test_first_row_does_not_depend_on_batches(spark, batches):
    df = live.dedup_watermark_first(spark, SF_SMALL, BatchRule(batches=batches))
    ok, said = compare(df, duck(SF_SMALL), ORACLES["dedup_watermark_first"])
    assert ok, said


def test_first_row_by_order_and_not_by_arrival(spark):
    rows = [("a", 5, 50), ("a", 3, 30), (None, 1, 1), (None, 1, 0), ("b", None, 7), ("a", 4000, 4000)]
    df = spark.createDataFrame(rows, "k STRING, sec LONG, n LONG").withColumn("t", F.timestamp_seconds("sec"))
    got = dedup_first(df, ["k"], ["t", "n"], "t", "1 hour").select("k", "sec", "n")
    assert _rows(got) == sorted([("a", 3, 30), (None, 1, 0), ("a", 4000, 4000)], key=repr)  # a row without time is in no window


def test_first_row_of_a_hot_key_is_aggregated_before_the_shuffle(spark):
    df = spark.range(10).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("t"), "id")
    plan = dedup_first(df, ["k"], ["t"], "t", "1 hour")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


# --- state as rows ---------------------------------------------------------------------------


@pytest.mark.parametrize("store", ["hdfs", "rocksdb"])
def test_open_windows_and_emitted_ones_are_all(spark, store):
    timed, _ = _timed(spark, keep=())
    counts = window_agg(timed, "timestamp", "1 day", keys=["item"], aggs=[F.count("item").alias("n")])
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(counts, "parquet", "append", path=out, checkpoint=ck, state_store=store, shuffle_partitions=3)
    emitted, held = spark.read.parquet(out), open_windows(spark, ck, ["item"], {"n": "count"})
    batch = window_agg(event_time(batch_transactions(spark, SF_SMALL)), "timestamp", "1 day", keys=["item"], aggs=[F.count("item").alias("n")])
    assert held.count() > 0 and _rows(emitted.unionAll(held)) == _rows(batch)
    assert state_metadata(spark, ck).select("numPartitions").first()[0] == 3


def test_state_of_an_earlier_batch(spark):
    parsed, st = stream_transactions(spark, SF_SMALL, keep=())
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(count_by(parsed.select("item"), "item"), "foreach_batch", "update", target=ChangelogWriter(out), checkpoint=ck, shuffle_partitions=2)
    for batch in (0, 3):
        held = state_rows(spark, ck, batch_id=batch).select("key.item", "value.count")
        changed = read_changelog(spark, out).where(F.col("batch_id") == batch).select("item", "count")
        assert _rows(held) == _rows(changed)


# --- late rows -------------------------------------------------------------------------------


def test_every_row_has_one_fate_and_aggregates_count_the_counted(spark):
    timed, st = _timed(spark, LATE)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(timed, "foreach_batch", "append", target=LateSplitter(out, ck, "timestamp", "1 hour"), checkpoint=ck)
    fates = read_split(spark, out, "offset BIGINT, timestamp TIMESTAMP, user_id BIGINT, item STRING, quantity INT")
    assert fates.count() == 1000 and fates.select("offset").distinct().count() == 1000
    late = fates.where("fate = 'late'").count()
    assert late > 0 and set(r.fate for r in fates.select("fate").distinct().collect()) == {"counted", "late"}

    timed, st = _timed(spark, LATE, keep=())
    counts = window_agg(timed, "timestamp", "1 hour", keys=["item"], aggs=[F.count("item").alias("n")])
    sink, ck2 = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    run(counts, "parquet", "append", path=sink, checkpoint=ck2, shuffle_partitions=2)
    counted = spark.read.parquet(sink).unionAll(open_windows(spark, ck2, ["item"], {"n": "count"})).agg(F.sum("n")).first()[0]
    assert counted + late == 1000
    by_window = window_agg(fates.where("fate = 'counted'"), "timestamp", "1 hour", keys=["item"], aggs=[F.count("item").alias("n")])
    assert _rows(by_window) == _rows(spark.read.parquet(sink).unionAll(open_windows(spark, ck2, ["item"], {"n": "count"})))


def test_a_replayed_batch_is_split_alike(spark):
    timed, _ = _timed(spark, LATE)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    splitter = LateSplitter(out, ck, "timestamp", "1 hour")
    held = {}

    def twice(batch_df, batch_id):
        splitter(batch_df, batch_id)
        held[batch_id] = _rows(spark.read.parquet(f"{out}/batch-{batch_id:08d}"))
        splitter(batch_df, batch_id)
        assert _rows(spark.read.parquet(f"{out}/batch-{batch_id:08d}")) == held[batch_id]

    run(timed, "foreach_batch", "append", target=twice, checkpoint=ck)
    assert len(held) == 4 and late_watermark_ms(spark, ck, 0) == 0 < late_watermark_ms(spark, ck, 3)


def test_sliding_windows_and_missing_times(spark):
    df = spark.createDataFrame([(None,), (0,), (599,), (600,), (1200,)], "sec LONG").select(F.timestamp_seconds("sec").alias("t"))
    from tideline.streaming.late import last_window_end

    ends = [r[0] and r[0] // 1_000_000 for r in df.select(last_window_end(F.col("t"), "20 minutes", "10 minutes")).collect()]
    assert ends == [None, 1200, 1200, 1800, 2400]


# --- recovery --------------------------------------------------------------------------------


def test_stateful_query_recovers_between_write_and_commit(spark):
    parsed, st = stream_transactions(spark, SF_SMALL, keep=())
    out, log, ck = (scratch_path(spark, k) for k in ("out", "attempts", "checkpoint"))
    target = AttemptLog(live.FailOnce(ChangelogWriter(out), 2), log)
    counts = count_by(parsed.select("item"), "item")
    _, again = run_with_restarts(
        lambda: run(counts, "foreach_batch", "update", target=target, checkpoint=ck, shuffle_partitions=2), restarts=2
    )
    assert again == 1
    assert {r.batch_id: r.attempts for r in read_attempts(spark, log).collect()} == {0: 1, 1: 1, 2: 2, 3: 1}
    ok, said = compare(read_changelog(spark, out), duck(SF_SMALL), ORACLES["mode_update_changelog"])
    assert ok, said


def test_restarts_end_and_other_errors_are_raised(spark):
    calls = []

    def fails():
        calls.append(1)
        raise RuntimeError("always")

    with pytest.raises(RuntimeError, match="always"):
        run_with_restarts(fails, restarts=2)
    assert len(calls) == 3
    with pytest.raises(RuntimeError, match="always"):
        run_with_restarts(fails, restarts=5, retry_on=lambda e: not isinstance(e, RuntimeError))
    assert len(calls) == 4


# --- merge by partition ----------------------------------------------------------------------


def _files(path):
    table = f"{path}/{list_names(path)[0]}"
    return {
        part: sorted(f"{v}/{n}" for v in list_names(f"{table}/{part}") for n in list_names(f"{table}/{part}/{v}"))
        for part in list_names(table)
        if part.startswith("part=")
    }


def _writer(path, **kw):
    return PartitionMergeWriter(path, "w", ["k"], kw.pop("part", "k % 3"), {"n": "target.n + source.n"}, {"k": "source.k", "n": "source.n"}, **kw)


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k LONG, n LONG")


def test_partitions_that_a_batch_does_not_touch_keep_their_files(spark):
    path = scratch_path(spark, "table")
    w = _writer(path)
    w(_batch(spark, [(0, 1), (1, 1), (2, 1), (3, 5)]), 0)
    before = _files(path)
    w(_batch(spark, [(1, 10), (4, 7)]), 1)
    after = _files(path)
    assert after["part=p0"] == before["part=p0"] and after["part=p2"] == before["part=p2"]
    assert any("batch=1" in n for n in after["part=p1"])
    got = read_partitions(spark, path)
    assert _rows(got.select("k", "n", "last_batch")) == [(0, 1, 0), (1, 11, 1), (2, 1, 0), (3, 5, 0), (4, 7, 1)]
    assert _rows(read_history(spark, path).select("batch_id", "rows_inserted", "rows_updated")) == [(0, 4, 0), (1, 1, 1)]


def test_a_replayed_batch_is_merged_once(spark):
    path = scratch_path(spark, "table")
    w = _writer(path)
    w(_batch(spark, [(0, 1), (1, 1)]), 0)
    for _ in range(3):
        w(_batch(spark, [(0, 10), (7, 2)]), 1)
    w(_batch(spark, [(0, 100)]), 2)
    w(_batch(spark, [(0, 100)]), 2)
    assert _rows(read_partitions(spark, path).select("k", "n")) == [(0, 111), (1, 1), (7, 2)]
    assert len([n for n in list_names(f"{path}/{list_names(path)[0]}/part=p0")]) == 2  # the newest and the one before
    with pytest.raises(RuntimeError, match="after a later one"):
        w(_batch(spark, [(0, 1)]), 1)
    with pytest.raises(RuntimeError, match="another writer"):
        PartitionMergeWriter(path, "other", ["k"], "k % 3", {}, {"k": "source.k", "n": "source.n"})(_batch(spark, [(0, 1)]), 3)


def test_partition_merge_equals_the_merge_of_the_whole(spark):
    import random

    from tideline.streaming import merge

    rng = random.Random(7)
    path = scratch_path(spark, "table")
    w = _writer(path, part=hash_part(["k"], 5), null_safe=True)
    whole = spark.createDataFrame([], "k LONG, n LONG")
    for b in range(4):
        keys = rng.sample(range(30), 8)
        rows = [(k, rng.randint(1, 9)) for k in keys] + ([(None, 3)] if b % 2 else [])
        w(_batch(spark, rows), b)
        whole = merge(whole, _batch(spark, rows), ["k"], {"n": "target.n + source.n"}, {"k": "source.k", "n": "source.n"}, null_safe=True)
        whole = spark.createDataFrame(whole.collect(), "k LONG, n LONG")
    assert _rows(read_partitions(spark, path).select("k", "n")) == _rows(whole)


def test_partition_names_hold_any_text(spark):
    path = scratch_path(spark, "table")
    w = PartitionMergeWriter(path, "w", ["k"], "k", {"n": "source.n"}, {"k": "source.k", "n": "source.n"}, null_safe=True)
    names = ["a/b", "a=b", "", "é ü", None, "..", "a_2fb", "A"]
    for b in range(2):
        w(spark.createDataFrame([(k, b) for k in names], "k STRING, n LONG"), b)
    assert _rows(read_partitions(spark, path).select("k", "n")) == sorted(((k, 1) for k in names), key=repr)


# --- delivery --------------------------------------------------------------------------------


class Flaky(OutboxSender):
    """Refuses the first ``bad`` attempts of each chunk, before or after it has taken the rows."""

    def __init__(self, path, bad, after):
        super().__init__(path)
        self.bad, self.after = bad, after

    def send(self, key, rows, attempt):
        if attempt > self.bad or self.after:
            super().send(key, rows, attempt)
        if attempt <= self.bad:
            raise ConnectionError(key)


def _ship_tests(spark):
    """Executors of these tests are threads of this machine; the class travels by value."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.mark.parametrize("after", [False, True])
def test_rows_arrive_once_under_retries_and_replays(spark, after):
    _ship_tests(spark)
    out, receipts = scratch_path(spark, "outbox"), scratch_path(spark, "receipts")
    writer = DeliveryWriter(Flaky(out, 2, after), receipts, ["id"], partitions=3, chunk_rows=40, tries=3)
    df = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    for _ in range(2):
        writer(df, 4)
    got = read_outbox(spark, out)
    assert got.count() == 500 and got.select("id").distinct().count() == 500
    told = spark.read.parquet(f"{receipts}/batch-*")
    assert told.agg(F.sum("rows")).first()[0] == 500 and {r.attempts for r in told.collect()} == {3}
    assert told.agg(F.max("rows")).first()[0] == 40 and told.count() == got.select("delivery").distinct().count()


def test_a_receiver_that_never_answers_fails_the_batch(spark):
    _ship_tests(spark)
    writer = DeliveryWriter(Flaky(scratch_path(spark, "outbox"), 9, False), scratch_path(spark, "receipts"), ["id"], tries=2)
    with pytest.raises(Exception, match="ConnectionError"):
        writer(spark.range(3).select("id"), 0)
    with pytest.raises(ValueError):
        DeliveryWriter(None, "x", ["id"], tries=0)


# --- joins, chained windows, sketches --------------------------------------------------------


def test_interval_join_on_batch_frames(spark):
    sec = lambda df: df.withColumn("t", F.timestamp_seconds("s"))
    left = sec(spark.createDataFrame([(1, 0), (1, 100), (2, 0), (None, 0), (3, None)], "k INT, s LONG"))
    right = sec(spark.createDataFrame([(1, 0), (1, 60), (1, 61), (1, 160), (None, 0), (2, -1)], "k INT, s LONG"))
    pairs = lambda how: _rows(interval_join(left, right, ["k"], "t", "t", "60 seconds", how).select("k", "s", "right_s"))
    inner = [(1, 0, 0), (1, 0, 60), (1, 100, 160)]
    assert pairs("inner") == sorted(inner, key=repr)
    assert pairs("left_outer") == sorted([*inner, (2, 0, None), (None, 0, None), (3, None, None)], key=repr)
    assert len(pairs("full_outer")) == 9
    with pytest.raises(ValueError):
        interval_join(left, right, ["k"], "t", "t", "1 hour", "cross")
    with pytest.raises(ValueError):
        interval_join(left, right, [], "t", "t", "1 hour")


def test_join_state_ends_with_the_bound(spark):
    clicks, st = _timed(spark)
    purchases, _ = _timed(spark)
    joined = interval_join(clicks, purchases, ["user_id"], "timestamp", "timestamp", "6 hours", "inner", "p_")
    ck = scratch_path(spark, "checkpoint")
    run(joined, "parquet", "append", path=scratch_path(spark, "out"), checkpoint=ck, shuffle_partitions=2)
    held = state_rows(spark, ck, join_side="left")
    span = held.agg(F.min("value.timestamp"), F.max("value.timestamp")).first()
    assert 0 < held.count() < 100 and (span[1] - span[0]).total_seconds() <= 6 * 3600 + 600


def test_chained_windows_on_batch_frames(spark):
    rows = [(s, "a") for s in (0, 10, 3599, 3600, 7200, 86_399)] + [(86_400, "a"), (5, "b")]
    df = spark.createDataFrame(rows, "s LONG, item STRING").withColumn("t", F.timestamp_seconds("s"))
    got = chained_window_agg(df, "t", "1 hour", "1 day", ["item"], [F.count(F.lit(1)).alias("n")], [F.max("n").alias("peak"), F.count(F.lit(1)).alias("hours")])
    assert _rows(got.select(F.unix_seconds("start"), "item", "peak", "hours")) == [(0, "a", 3, 4), (0, "b", 1, 1), (86_400, "a", 1, 1)]


def test_sketches_merge_as_if_counted_at_once(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("h"), (F.col("id") % 20_011).alias("u")).unionAll(spark.range(3).select("id", F.lit(None)))
    parts = distinct_sketch(df, ["h"], "u")
    apart = {r.h: r.n for r in merge_sketches(parts, ["h"], "n").collect()}
    exact = {r.h: r.n for r in df.groupBy("h").agg(F.count_distinct("u").alias("n")).collect()}
    assert all(abs(apart[h] - exact[h]) <= 3 * 1.04 / 2**7.5 * exact[h] for h in exact)
    total = merge_sketches(parts.withColumn("all", F.lit(1)), ["all"], "n").first().n
    assert abs(total - 20_011) <= 3 * 1.04 / 2**7.5 * 20_011


# --- compaction ------------------------------------------------------------------------------


def test_compaction_keeps_the_newest_rows_and_may_be_repeated(spark):
    path = scratch_path(spark, "log")
    write = ChangelogWriter(path, partition_by=["day"])
    batch = lambda rows: spark.createDataFrame(rows, "day STRING, k INT, n LONG")
    write(batch([("d1", 1, 10), ("d2", 2, 20)]), 0)
    write(batch([("d1", 1, 11), ("d1", 3, 30), ("d3", 4, None)]), 1)
    want = [(1, 11), (2, 20), (3, 30), (4, None)]
    rows = lambda: _rows(read_compacted(spark, path, ["k"], "day").select("k", "n"))
    assert rows() == want
    assert compact_closed(spark, path, ["k"], "day", "d2") == ["d1"] and rows() == want
    assert not [n for b in list_names(path) if b.startswith("batch-") for n in list_names(f"{path}/{b}") if n == "day=d1"]
    write(batch([("d1", 1, 12), ("d2", 2, 21)]), 2)  # a row that comes after all for a compacted day
    want = [(1, 12), (2, 21), (3, 30), (4, None)]
    assert rows() == want
    assert compact_closed(spark, path, ["k"], "day", "d3") == ["d1", "d2"] and rows() == want
    assert compact_closed(spark, path, ["k"], "day", "d9") == ["d3"] and rows() == want
    assert compact_closed(spark, path, ["k"], "day", "d9") == [] and rows() == want
    assert read_compacted(spark, path, ["k"], "day").where("not compacted").count() == 0


def test_an_incomplete_batch_is_not_read(spark):
    path = scratch_path(spark, "log")
    ChangelogWriter(path)(spark.range(3), 0)
    spark.range(5).withColumn("batch_id", F.lit(1)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batch-00000001")
    assert read_changelog(spark, path).count() == 3


def test_table_stream_reads_a_folder_and_what_is_added(spark):
    path, out, ck = (scratch_path(spark, k) for k in ("table", "out", "checkpoint"))
    spark.range(10).write.parquet(path)
    go = lambda: run(table_stream(spark, path, files_per_batch=2), "parquet", path=out, checkpoint=ck)
    go()
    assert spark.read.parquet(out).count() == 10
    spark.range(10, 15).write.mode("append").parquet(path)
    go()
    assert _rows(spark.read.parquet(out)) == [(i,) for i in sorted(range(15), key=lambda i: repr((i,)))]


def test_start_earliest_reads_every_record_of_the_topic_by_position(spark):
    path = scratch_path(spark, "tables")
    ids = [*range(40), 39, 39, None, None, -4]
    rows = [(None if i == 3 else dt.datetime(2024, 1, 1), i, None if i == 5 else "click") for i in ids]
    frame = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, event_id LONG, event_type STRING")
    frame = frame.withColumns({"user_id": F.lit(1).cast("long"), "props": F.lit("{}"), "value": F.lit(1.5)})
    frame.write.parquet(f"{path}/events.parquet")
    got = QUERIES["start_earliest"](spark, path)
    assert got.columns == ["partition", "offset"]
    want = [(None if i is None else int(math.fmod(i, 3)), i) for i in ids]
    assert _rows(got) == sorted(want, key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS FROM read_parquet('{path}/events.parquet/*.parquet')")
    told = con.sql(ORACLES["start_earliest"])
    assert told.columns == got.columns and sorted(told.fetchall(), key=repr) == _rows(got)


def test_split_report_of_the_query_adds_up(spark):
    rows = live.late_rows(spark, SF_SMALL).collect()
    assert sum(r.rows for r in rows) == 1000 and all(r.rows == r.late_rows + r.counted_rows for r in rows)
