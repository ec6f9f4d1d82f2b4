"""Plan regression tests: pruning, pushdown and partial aggregation stay in place."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tideline.operators import dedup
from tideline.plans import catalog
from tideline.plans.common import batch_transactions, event_time
from tideline.sources.replay import LATE, envelope_from_events


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_item_counts_reads_one_column_and_aggregates_partially(spark):
    plan = _plan(catalog.item_counts(spark, SF_SMALL))
    assert "ReadSchema: struct<event_type:string>" in plan
    assert "partial_count" in plan


def test_staging_pushes_the_id_range_to_the_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lo, hi = LATE.id_range(3, 1000)
    assert (lo, hi) == (250, None)
    src = ev.where(F.col("event_id") >= lo).where(LATE.column(1000) == 3)
    plan = _plan(envelope_from_events(src))
    assert f"GreaterThanOrEqual(event_id,{lo})" in plan
    lo, hi = LATE.id_range(1, 1000)
    assert (lo, hi) == (None, 500)
    assert "props" not in plan.split("ReadSchema:")[1].splitlines()[0]


def test_exact_distinct_shuffles_on_item_and_user_first(spark):
    plan = _plan(catalog.distinct_users_batch(spark, SF_SMALL))
    assert "hashpartitioning(item" in plan and "user_id" in plan
    assert "partial_count(distinct" in plan


def test_batch_dedup_aggregates_before_the_shuffle(spark):
    df = dedup(event_time(batch_transactions(spark, SF_SMALL)), ["user_id", "item"], ["timestamp", "offset"])
    plan = _plan(df)
    assert "partial_min_by" in plan
    assert plan.index("partial_min_by") > plan.index("Exchange")  # partial side is below the exchange


def test_streaming_window_count_aggregates_partially_before_the_state_store(spark):
    from tideline.operators import window_agg, with_watermark
    from tideline.plans.common import stream_transactions
    from tideline.session import scratch_path
    from tideline.streaming import run

    parsed, _ = stream_transactions(spark, SF_SMALL, keep=())
    timed = with_watermark(event_time(parsed), "timestamp", "10 minutes")
    df = window_agg(timed, "timestamp", "1 hour", keys=["item"],
                    aggs=[F.count("item").alias("item_count")], ntz=True)
    q = run(df, "parquet", "append", path=scratch_path(spark, "out"), checkpoint=scratch_path(spark, "ck"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    plan = buf.getvalue()
    assert "StateStoreSave" in plan and "StateStoreRestore" in plan
    assert "REQUIRED_BY_STATEFUL_OPERATOR" in plan
    assert plan.index("partial_count") > plan.index("Exchange")
