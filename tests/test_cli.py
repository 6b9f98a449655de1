"""The command line runs the three jobs end to end (own JVM, local mode)."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL
from raresift.session import scratch_path
from raresift.sources.fixtures import transactions

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    cmd = [sys.executable, "-m", "raresift", "--master", "local[2]", *args]
    done = subprocess.run(cmd, cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [ln for ln in done.stdout.splitlines() if ln.startswith("{")]
    return json.loads(lines[-1]) if lines else None


def test_train_publish_score(spark):
    base = scratch_path(spark, "cli")
    t = transactions(spark, SF_SMALL, faults=False).drop("txn_key")
    t.coalesce(1).write.option("header", True).csv(f"{base}/train")
    t.drop("Class").limit(500).coalesce(1).write.option("header", True).csv(f"{base}/stream")

    summary = _run("train", "--data-path", f"{base}/train", "--output-dir", f"{base}/out",
                   "--model-output-dir", f"{base}/model")
    assert summary["rows_before_cleaning"] == t.count()
    assert summary["max_iter"] == 10

    _run("publish", "--csv-path", f"{base}/stream", "--output-dir", f"{base}/msgs")
    report = _run("score-stream", "--model-dir", f"{base}/model", "--source", f"{base}/msgs",
                  "--work-dir", f"{base}/work", "--report-path", f"{base}/report")
    assert report["total_messages_seen"] == 500
    assert report["sentinel_total_published"] == 500
    assert report["complete"] is True


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    done = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [ln for ln in done.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["metric"] == "total_sec" and out["unit"] == "sec" and out["sf"] == 0.001
    assert out["value"] > 0 and set(out["queries"]) >= {"class_profile", "training_summary", "stream_scored"}
