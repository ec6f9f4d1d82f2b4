"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is timed end to end (query start, all
micro-batches of the replayed topic, sink commit, reading the whole result
back, materialized with the ``noop`` writer).
Staging the replay topic, a stand-in for the Kafka topic, is done once and reported as
``stage_sec`` and within ``total_with_staging``. ``batches`` gives for each streaming query its
micro-batches' median milliseconds and the rows a second over all of them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "item_counts",
    "parse_transactions",
    "event_time",
    "mode_complete",
    "mode_update_changelog",
    "kafka_sink_records",
    "tumbling_count",
    "sliding_count",
    "tumbling_append",
    "watermark_append",
    "late_data_append",
    "upsert_replace",
    "dedup_batch",
    "validate_good",
]


def batch_listener(seen: list[tuple[int, int]]):
    """Appends (rows, milliseconds) of each micro-batch that read rows."""
    from pyspark.sql.streaming import StreamingQueryListener

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            p = event.progress
            if p.numInputRows:
                seen.append((p.numInputRows, p.durationMs["triggerExecution"]))

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            pass

    return Listener()


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    folder = os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="tideline-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tideline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from tideline.plans import QUERIES
    from tideline.plans.common import staged
    from tideline.sources.replay import EVEN, LATE

    t = time.perf_counter()
    staged(spark, sf_dir, EVEN)
    staged(spark, sf_dir, LATE)
    staged(spark, sf_dir, EVEN, "faulty")
    stage_sec = time.perf_counter() - t

    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    timings: dict[str, float] = {}
    spread: dict[str, float] = {}
    rows: dict[str, int] = {}
    batches: dict[str, dict[str, float]] = {}
    seen: list[tuple[int, int]] = []
    spark.streams.addListener(batch_listener(seen))
    for name in chosen:
        samples = []
        seen.clear()
        for _ in range(runs):
            t = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            # Materialize the whole result JVM-side (no Python row conversion).
            df.write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t)
        rows[name] = df.count()
        time.sleep(0.5)  # progress events arrive a little after the query's end
        if seen:
            ms = [m for _, m in seen]
            batches[name] = {
                "median_ms": statistics.median(ms),
                "rows_per_sec": round(sum(r for r, _ in seen) / sum(ms) * 1000),
            }
        timings[name] = round(statistics.median(samples), 3)
        spread[name] = round(max(samples) - min(samples), 3)
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "spread": spread,
                "rows": rows,
                "batches": batches,
                "stage_sec": round(stage_sec, 3),
                "total_with_staging": round(total + stage_sec, 3),
                "runs": runs,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
