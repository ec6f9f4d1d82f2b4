"""Streaming semantics: negative cases, stream = batch, chunking, changelog, restart."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tideline.functions import decode, parse_json
from tideline.operators import count_by, window_agg, with_watermark
from tideline.plans import catalog
from tideline.plans.common import batch_transactions, event_time, latest_batch, report
from tideline.session import scratch_path
from tideline.sources.replay import EVEN, BatchRule, read_replay, stage_topic
from tideline.streaming import ChangelogWriter, Trigger, read_changelog, run, start


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def _stream(spark, rule=EVEN, files=None):
    st = stage_topic(spark, _events(spark), scratch_path(spark, "stage"), rule, files_per_batch=files)
    return parse_json(decode(read_replay(spark, st), key=False)), st


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_aggregate_without_watermark_is_rejected(spark):
    parsed, _ = _stream(spark)
    with pytest.raises(Exception, match="(?i)append"):
        q = start(count_by(parsed, "item"), "memory", "append", name="rejected_append")
        q.awaitTermination(60)
        raise RuntimeError(str(q.exception()))


def test_file_sink_rejects_update(spark):
    parsed, _ = _stream(spark)
    with pytest.raises(ValueError, match="append mode only"):
        start(count_by(parsed, "item"), "parquet", "update", path="/x", checkpoint="/y")


def test_complete_without_aggregation_is_rejected(spark):
    parsed, _ = _stream(spark)
    with pytest.raises(Exception, match="(?i)complete"):
        start(parsed, "memory", "complete", name="rejected_complete")


def test_ntz_watermark_is_rejected(spark):
    df = spark.createDataFrame([], "t TIMESTAMP_NTZ")
    with pytest.raises(TypeError):
        with_watermark(df, "t", "10 minutes")


def test_slide_larger_than_size_is_rejected(spark):
    df = spark.createDataFrame([], "t TIMESTAMP, item STRING")
    with pytest.raises(Exception):
        window_agg(df, "t", "10 minutes", "20 minutes", aggs=[F.count("*").alias("n")]).collect()


def test_two_triggers_are_rejected():
    with pytest.raises(ValueError):
        Trigger(available_now=True, processing_time="1 second")


def test_run_refuses_to_drain_a_continuous_query(spark):
    rate = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="continuous"):
        run(rate, "noop", "append", trigger=Trigger(continuous="1 second"))


def test_continuous_trigger_runs_map_only_and_refuses_aggregates(spark):
    # Continuous tasks hold one core each for their lifetime: leave cores free.
    rate = spark.readStream.format("rate").option("rowsPerSecond", 50).option("numPartitions", 2).load()
    q = start(rate.select((F.col("value") * 2).alias("v")), "memory", "append",
              trigger=Trigger(continuous="1 second"), name="continuous_map")
    try:
        import time

        deadline = time.time() + 60
        while time.time() < deadline and spark.table("continuous_map").count() == 0:
            time.sleep(1)
        assert spark.table("continuous_map").count() > 0
    finally:
        q.stop()
    parsed, _ = _stream(spark)
    with pytest.raises(Exception):  # the file source has no continuous mode
        qf = start(parsed, "memory", "append", trigger=Trigger(continuous="1 second"), name="continuous_file")
        qf.awaitTermination(30)
        err = qf.exception()
        qf.stop()
        if err:
            raise RuntimeError(str(err))
    with pytest.raises(Exception):
        q2 = start(count_by(rate, "value"), "memory", "complete",
                   trigger=Trigger(continuous="1 second"), name="continuous_agg")
        q2.awaitTermination(30)
        err = q2.exception()
        q2.stop()
        if err:
            raise RuntimeError(str(err))


def test_stream_equals_batch_for_windows(spark):
    parsed, st = _stream(spark)
    aggs = [F.count("item").alias("item_count")]
    streamed = window_agg(event_time(parsed), "timestamp", "1 hour", keys=["item"], aggs=aggs, ntz=True)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    run(streamed, "foreach_batch", "complete", target=ChangelogWriter(out), checkpoint=ck)
    got = latest_batch(read_changelog(spark, out))
    batch = window_agg(event_time(batch_transactions(spark, SF_SMALL)), "timestamp", "1 hour",
                       keys=["item"], aggs=aggs, ntz=True)
    assert _sorted(got) == _sorted(batch)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_chunking_invariance_of_complete_counts(spark, batches):
    parsed, st = _stream(spark, BatchRule(batches=batches), files=2)
    out = scratch_path(spark, "out")
    q = run(count_by(parsed, "item"), "foreach_batch", "complete", target=ChangelogWriter(out),
            checkpoint=scratch_path(spark, "ck"))
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == batches
    got = latest_batch(read_changelog(spark, out))
    assert _sorted(got) == _sorted(count_by(batch_transactions(spark, SF_SMALL), "item"))


def test_last_update_row_equals_complete_row(spark):
    changelog = catalog.mode_update_changelog(spark, SF_SMALL)
    last = changelog.groupBy("item").agg(F.max_by("count", "batch_id").alias("count"))
    assert _sorted(last) == _sorted(catalog.mode_complete(spark, SF_SMALL).drop("batches"))


def test_restart_equals_uninterrupted(spark):
    resumed, whole = catalog.checkpoint_resume(spark, SF_SMALL), catalog.mode_complete(spark, SF_SMALL)
    assert _sorted(resumed.drop("rows_after")) == _sorted(whole.drop("batches"))


def test_once_trigger_is_one_batch(spark):
    parsed, st = _stream(spark)
    q = run(count_by(parsed, "item"), "foreach_batch", "complete",
            target=ChangelogWriter(scratch_path(spark, "out")),
            checkpoint=scratch_path(spark, "ck"), trigger=Trigger(once=True))
    assert [p["numInputRows"] for p in q.recentProgress] == [1000]


def test_late_rows_two_batches_late_are_dropped(spark):
    late = catalog.late_data_append(spark, SF_SMALL)
    on_time = catalog.watermark_append(spark, SF_SMALL)
    assert late.agg(F.sum("item_count")).first()[0] < on_time.agg(F.sum("item_count")).first()[0]


def test_state_store_choice_gives_same_result(spark):
    a = catalog.watermark_append(spark, SF_SMALL)
    b = catalog.watermark_append_rocksdb(spark, SF_SMALL)
    assert {r.store for r in b.collect()} == {"RocksDBStateStoreProvider"}
    assert _sorted(a) == _sorted(b.drop("store"))


def test_report_casts_timestamps(spark):
    df = spark.createDataFrame([(1,)], "a INT").select(F.current_timestamp().alias("t"))
    assert report(df).schema["t"].dataType.simpleString() == "timestamp_ntz"


def test_console_sink_smoke(spark):
    parsed, _ = _stream(spark)
    q = run(parsed.select("item"), "console", "append", options={"numRows": "2"})
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1000


def test_table_sink_rejects_update(spark):
    parsed, _ = _stream(spark)
    with pytest.raises(ValueError, match="append mode only"):
        start(count_by(parsed, "item"), "table", "update", target="t", checkpoint="/y")
    # Spark refuses it as well when asked directly
    name = "upd_" + scratch_path(spark, "x").rsplit("/", 1)[1][:8]
    spark.sql(f"CREATE TABLE {name} (item STRING, count BIGINT) USING parquet "
              f"LOCATION '{scratch_path(spark, 'table')}'")
    with pytest.raises(Exception, match="(?i)update|unsupported"):
        q = (count_by(parsed, "item").writeStream.outputMode("update")
             .option("checkpointLocation", scratch_path(spark, "ck")).toTable(name))
        q.awaitTermination(60)
        err = q.exception()
        if err:
            raise RuntimeError(str(err))


def test_memory_append_cannot_resume(spark):
    parsed, _ = _stream(spark)
    ck = scratch_path(spark, "ck")
    run(parsed.select("item"), "memory", "append", name="mem_once", checkpoint=ck)
    with pytest.raises(Exception, match="(?i)recover"):
        run(parsed.select("item"), "memory", "append", name="mem_again", checkpoint=ck)


@pytest.mark.parametrize("batches", [1, 2])
def test_chunking_invariance_of_append_without_late_rows(spark, batches):
    aggs = [F.count("item").alias("item_count")]

    def windows(rule):
        parsed, st = _stream(spark, rule, files=2)
        timed = with_watermark(event_time(parsed), "timestamp", "10 minutes")
        df = window_agg(timed, "timestamp", "1 hour", keys=["item"], aggs=aggs, ntz=True)
        out = scratch_path(spark, "out")
        run(df, "parquet", "append", path=out, checkpoint=scratch_path(spark, "ck"))
        return _sorted(spark.read.parquet(out))

    assert windows(BatchRule(batches=batches)) == windows(EVEN)


def test_watermark_dedup_of_a_hot_key(spark):
    from datetime import timedelta

    from tideline.operators import dedup_within_watermark

    parsed, st = _stream(spark)
    # One hot key: every row gets the same (user_id, item).
    hot = event_time(parsed).withColumn("user_id", F.lit(1)).withColumn("item", F.lit("hot"))
    out = scratch_path(spark, "out")
    run(dedup_within_watermark(hot, ["user_id", "item"], "timestamp", "10 minutes"),
        "parquet", "append", path=out, checkpoint=scratch_path(spark, "ck"))
    rows = sorted(r.timestamp for r in spark.read.parquet(out).collect())
    # Each emitted row is at least the delay apart from the one before (its state is kept that long).
    assert rows and all(b - a >= timedelta(minutes=10) for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize(
    "name,size,slide,agg",
    [
        ("tumbling_count", "1 hour", None, lambda: F.count("item").alias("item_count")),
        ("tumbling_avg", "1 hour", None, lambda: F.avg("quantity").alias("avg_quantity")),
        ("sliding_count", "20 minutes", "10 minutes", lambda: F.count("item").alias("item_count")),
        ("sliding_sum", "15 minutes", "5 minutes", lambda: F.sum("quantity").alias("sum_quantity")),
    ],
)
def test_stream_equals_batch_for_every_window_query(spark, name, size, slide, agg):
    streamed = catalog.QUERIES[name](spark, SF_SMALL)
    batch = window_agg(event_time(batch_transactions(spark, SF_SMALL)), "timestamp", size, slide,
                       keys=["item"], aggs=[agg()], ntz=True)
    assert _sorted(streamed.select(*batch.columns)) == _sorted(batch)


def test_update_without_aggregation_behaves_like_append(spark):
    parsed, _ = _stream(spark)
    run(parsed.select("item", "quantity"), "memory", "update", name="update_no_agg")
    assert spark.table("update_no_agg").count() == 1000


def test_complete_mode_keeps_windows_behind_the_watermark(spark):
    parsed, _ = _stream(spark)
    aggs = [F.count("item").alias("item_count")]
    timed = with_watermark(event_time(parsed), "timestamp", "10 minutes")
    df = window_agg(timed, "timestamp", "1 hour", keys=["item"], aggs=aggs, ntz=True)
    run(df, "memory", "complete", name="complete_wm")
    batch = window_agg(event_time(batch_transactions(spark, SF_SMALL)), "timestamp", "1 hour",
                       keys=["item"], aggs=aggs, ntz=True)
    assert _sorted(spark.table("complete_wm")) == _sorted(batch)


def test_watermark_evicts_closed_windows_from_state(spark):
    from tideline.streaming import progress_frame

    parsed, _ = _stream(spark)
    timed = with_watermark(event_time(parsed), "timestamp", "10 minutes")
    df = window_agg(timed, "timestamp", "1 hour", keys=["item"],
                    aggs=[F.count("item").alias("item_count")], ntz=True)
    out = scratch_path(spark, "out")
    q = run(df, "parquet", "append", path=out, checkpoint=scratch_path(spark, "ck"))
    emitted = spark.read.parquet(out).count()
    prog = progress_frame(spark, q).orderBy("batch_id").collect()
    # After the closing batch only windows ending after the final watermark remain.
    assert prog[-1].num_input_rows == 0
    assert prog[-1].state_rows < 20 < emitted
    assert max(p.state_rows for p in prog) < emitted


def test_late_rows_are_reported_as_dropped_by_the_watermark(spark):
    from tideline.sources.replay import LATE
    from tideline.streaming import progress_frame

    def dropped(rule):
        parsed, _ = _stream(spark, rule)
        timed = with_watermark(event_time(parsed), "timestamp", "10 minutes")
        df = window_agg(timed, "timestamp", "1 hour", keys=["item"],
                        aggs=[F.count("item").alias("item_count")], ntz=True)
        q = run(df, "parquet", "append", path=scratch_path(spark, "out"), checkpoint=scratch_path(spark, "ck"))
        return progress_frame(spark, q).agg(F.sum("state_rows_dropped_by_watermark")).first()[0]

    assert dropped(EVEN) == 0
    assert dropped(LATE) > 0


def test_resume_reads_only_new_input(spark):
    from tideline.sources.replay import EVEN

    ev = _events(spark)
    path, ck = scratch_path(spark, "stage"), scratch_path(spark, "ck")
    out = scratch_path(spark, "out")
    inputs = []
    for batches in (range(0, 2), range(2, 4)):
        st = stage_topic(spark, ev, path, EVEN, batches=batches, n=1000, files_per_batch=2)
        counts = count_by(parse_json(decode(read_replay(spark, st), key=False)), "item")
        q = run(counts, "foreach_batch", "complete", target=ChangelogWriter(out), checkpoint=ck)
        inputs.append(sum(p["numInputRows"] for p in q.recentProgress))
    assert inputs == [500, 500]


def test_memory_complete_resume_without_new_data_is_empty(spark):
    parsed, _ = _stream(spark)
    ck = scratch_path(spark, "ck")
    run(count_by(parsed, "item"), "memory", "complete", name="mem_complete_a", checkpoint=ck)
    assert spark.table("mem_complete_a").count() == 5
    # Same checkpoint, no new files: no batch runs, so the new memory table stays empty.
    run(count_by(parsed, "item"), "memory", "complete", name="mem_complete_b", checkpoint=ck)
    assert spark.table("mem_complete_b").count() == 0


def test_good_and_bad_rows_are_the_input(spark):
    both = catalog._validated(spark, SF_SMALL)
    assert both.count() == both.select("offset").distinct().count() == 1000
    assert both.where(F.col("valid") != (F.col("reasons") == "")).count() == 0


def test_queries_started_together_keep_their_own_settings(spark):
    from tideline.streaming import checkpoint_offsets

    parsed, _ = _stream(spark)
    cks = {3: scratch_path(spark, "ck"), 5: scratch_path(spark, "ck")}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    started = [
        start(count_by(parsed, "item"), "foreach_batch", "complete", checkpoint=ck, shuffle_partitions=n,
              target=ChangelogWriter(scratch_path(spark, "out")))
        for n, ck in cks.items()
    ]
    for q in started:
        q.awaitTermination()
        assert q.exception() is None
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    for n, ck in cks.items():
        confs = checkpoint_offsets(spark, ck).select("conf").collect()
        assert {r.conf["spark.sql.shuffle.partitions"] for r in confs} == {str(n)}


def test_wide_user_ids_and_rows_without_id(spark, tmp_path):
    ev = _events(spark).limit(40)
    wide = ev.withColumn("user_id", F.col("event_id") + F.lit(5_000_000_000)).withColumn("event_type", F.lit("a"))
    extra = wide.limit(1).withColumn("event_id", F.lit(None).cast("long")).withColumn("event_type", F.lit("b"))
    rows = wide.unionByName(extra).withColumn("event_id", F.col("event_id").cast("long"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    got = {r["item"]: r["distinct_users"] for r in catalog.distinct_users_batch(spark, str(tmp_path)).collect()}
    assert got == {"a": 40, "b": 1}
    streamed = catalog.parse_transactions(spark, str(tmp_path)).collect()
    assert len(streamed) == 41 and sum(r["offset"] is None for r in streamed) == 1
    assert all(r["user_id"] >= 5_000_000_000 for r in streamed)
    assert all(r["within_3_rsd"] for r in catalog.approx_users_stream(spark, str(tmp_path)).collect())
