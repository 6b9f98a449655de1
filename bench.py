"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full through the ``noop`` sink (every row
computed, nothing collected to the driver).  A small warm-up query runs
first (SQL, MLlib and streaming paths at sf0.001) so JVM start-up and
class loading are not charged to the first query of each kind.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_counts",
    "class_profile",
    "train_test_counts",
    "score_closed_form",
    "confusion_matrix",
    "auc_roc",
    "auc_pr",
    "decode_events",
    "card_messages_scored",
    "training_summary",
    "stream_scored",
    "stream_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from raresift.plans.queries import QUERIES
    from raresift.session import build_session

    spark = build_session(
        f"local[{cpus}]",
        app_name="raresift-bench",
        shuffle_partitions=int(cpus) * 2,
        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    )
    # Warm-up on the smallest table set (not timed): loads and JIT-compiles
    # the SQL, MLlib and streaming code paths once.
    warm = "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    for name in ("class_profile", "auc_roc", "training_summary", "stream_report"):
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    jvm = spark.sparkContext._jvm
    for name in HEADLINE:
        jvm.System.gc()  # untimed: the previous query's garbage is not charged to this one
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()

    # Per-micro-batch latency (read, decode, score, commit) of a stream run
    # with small batches; reported next to the total, not added to it.
    from raresift.plans.queries import EVENT_SCORER
    from raresift.plans.streaming_job import publish, run_stream_scoring
    from raresift.session import scratch_path
    from raresift.sources import fixtures as fx

    msgs = fx.event_messages(spark, sf_dir)
    src = publish([msgs["first"], msgs["body"].repartition(20), msgs["redelivered"]], scratch_path(spark, "bench-msgs"))
    run = run_stream_scoring(
        spark, src, scratch_path(spark, "bench-stream"), fx.EVENT_FEATURES, EVENT_SCORER, ["label"],
        max_files_per_trigger=1,
    ).run
    lat = sorted(run.batch_ms)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "stream_messages": events,
        "stream_msgs_per_sec": round(events / times["stream_scored"], 1) if times.get("stream_scored") else None,
        "stream_batches": run.batches,
        "stream_batch_median_sec": round(lat[len(lat) // 2] / 1000, 3) if lat else None,
        "stream_batch_max_sec": round(lat[-1] / 1000, 3) if lat else None,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
