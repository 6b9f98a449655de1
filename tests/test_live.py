"""Restarts, running report, admission, ends and keyed state of streams."""

import json
import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import raresift.plans.live as live
from conftest import SF_SMALL
from raresift.plans.streaming_job import publish, run_stream_scoring
from raresift.session import scratch_path
from raresift.sources import fixtures as fx
from raresift.sources.message_log import FORMAT, MessageLogReader, append_messages, log_end, log_segments
from raresift.streaming.first_flagged import first_per_key
from raresift.streaming.lifecycle import follow
from raresift.operators.events import decode_messages
from raresift.streaming import recovery
from raresift.streaming.recovery import audit_deliveries
from raresift.streaming.report import report_counts
from raresift.streaming.running import KEPT_REPORTS, running_report, start_running_report
from raresift.streaming.scorer import message_stream, score_messages, start_sink


def texts(spark, n, prefix="m"):
    return spark.range(n).select(F.concat(F.lit(prefix), "id").alias("value"))


def test_log_numbers_messages(spark):
    log = scratch_path(spark, "log")
    assert log_end(log) == 0
    assert append_messages(texts(spark, 1000).repartition(5), log) == 1000
    assert append_messages(texts(spark, 0), log) == 1000
    assert append_messages(texts(spark, 7, "n"), log) == 1007
    assert [s[:2] for s in log_segments(log)] == [(0, 1000), (1000, 7)]
    rows = spark.read.parquet(*[s[2] for s in log_segments(log)]).collect()
    assert sorted(r.offset for r in rows) == list(range(1007))
    assert {r.value for r in rows} == {f"m{i}" for i in range(1000)} | {f"n{i}" for i in range(7)}


def test_admission_by_rows_and_by_time(spark, monkeypatch):
    log = scratch_path(spark, "log")
    clock = [100.0]
    monkeypatch.setattr(time, "monotonic", lambda: clock[0])
    reader = MessageLogReader({"path": log, "group": "g"})
    assert reader.latestOffset() == {"offset": 0, "by": "start"}
    append_messages(texts(spark, 50), log)
    assert reader.latestOffset() == {"offset": 50, "by": "rows"}
    append_messages(texts(spark, 49), log)
    assert reader.latestOffset() == {"offset": 50, "by": "rows"}  # too few, too soon
    clock[0] += 1.1
    assert reader.latestOffset() == {"offset": 99, "by": "delay"}
    append_messages(texts(spark, 3), log)
    clock[0] += 0.5
    assert reader.latestOffset()["offset"] == 99
    append_messages(texts(spark, 60), log)
    assert reader.latestOffset() == {"offset": 162, "by": "rows"}
    parts = reader.partitions({"offset": 40}, {"offset": 101})
    assert [(p.start, p.end) for p in parts] == [(40, 50), (50, 99), (99, 101)]
    offsets = [o for p in parts for b in reader.read(p) for o in b.column(0).to_pylist()]
    assert sorted(offsets) == list(range(40, 101))
    assert reader.partitions({"offset": 101}, {"offset": 101}) == []
    reader.commit({"offset": 162, "by": "rows"})
    again = MessageLogReader({"path": log, "group": "g"})
    assert again.acknowledged() == 162 and again.latestOffset() == {"offset": 162, "by": "start"}
    assert MessageLogReader({"path": log, "group": "other"}).acknowledged() == 0


def test_log_stream_goes_on_after_a_restart(spark):
    """Two runs over one checkpoint read every offset once; the log knows what is done."""
    m, log, work = fx.event_messages(spark, SF_SMALL), scratch_path(spark, "log"), scratch_path(spark, "stream")
    options = {"path": log, "group": "scorer"}

    def run(*deliveries):
        for d in deliveries:
            append_messages(d, log)
        return run_stream_scoring(
            spark, None, work, fx.EVENT_FEATURES, live.EVENT_SCORER, ["label"], live=True, max_runtime_seconds=60,
            processing_time="200 milliseconds", fmt=FORMAT, options=options,
        )

    first = run(m["body"], m["first"])
    assert first.run.finished and first.sink.count() == 1001
    second = run(m["redelivered"], m["first"])
    total = 1002 + m["redelivered"].count()
    assert second.run.finished and second.sink.count() == total == log_end(log)
    assert second.sink.select("source_file").distinct().count() == total
    assert MessageLogReader(options).acknowledged() <= total


def test_a_batch_that_runs_again_is_stored_once(spark):
    """The commit record of the last batch is lost, as if the driver had died before writing it."""
    import os

    m, source, work = fx.event_messages(spark, SF_SMALL), scratch_path(spark, "messages"), scratch_path(spark, "stream")
    publish([m["body"].repartition(4)], source)

    def run(**limits):
        return run_stream_scoring(spark, source, work, fx.EVENT_FEATURES, live.EVENT_SCORER, ["label"], max_files_per_trigger=1, **limits)

    run()
    commits = f"{work}/checkpoint/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    os.remove(f"{commits}/{last}")
    crc = f"{commits}/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    out = run()
    messages = spark.read.text(source).select("value", F.col("_metadata.file_name").alias("source_file"))
    audit = audit_deliveries(messages, out.sink, fx.EVENT_FEATURES).collect()
    assert sum(r.deliveries for r in audit) == 1000 and all(r.missing == r.repeated == 0 for r in audit)


def test_audit_finds_losses_and_repeats(spark):
    m, source, work = fx.event_messages(spark, SF_SMALL), scratch_path(spark, "messages"), scratch_path(spark, "stream")
    publish([m["body"]], source)
    out = run_stream_scoring(spark, source, work, fx.EVENT_FEATURES, live.EVENT_SCORER, ["label"])
    messages = spark.read.text(source).select("value", F.col("_metadata.file_name").alias("source_file"))
    damaged = out.sink.filter("__id IS NULL OR __id <> 100").unionByName(out.sink.filter("__id IN (7, 8)"))
    audit = {r.kind: (r.missing, r.repeated) for r in audit_deliveries(messages, damaged, fx.EVENT_FEATURES).collect()}
    assert audit == {"ok": (1, 2), "invalid": (0, 0), "bad": (0, 0)}


def test_audit_deals_all_rows_before_it_groups_them(spark, monkeypatch):
    """A task that groups its part of the source first holds a row for nearly each message."""
    monkeypatch.setattr(recovery, "TASK_ROWS", 50)
    lines = ['{"V1": "1", "__id": 4}'] * 400 + [f'{{"V1": "{i}", "__id": {i}}}' for i in range(300)] + ["junk"] * 50
    messages = spark.createDataFrame([(v, "f") for v in lines], "value string, source_file string").repartition(3)
    sink = decode_messages(messages, ["V1"], keep=["source_file"]).filter("__id IS NULL OR __id <> 7")
    audit = audit_deliveries(messages, sink, ["V1"])
    text = audit._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in text and "HashAggregate" not in text[text.index("REPARTITION_BY_NUM") :]
    assert f", {-(-1499 // 50)}), REPARTITION_BY_NUM" in text
    assert {r.kind: r[1:] for r in audit.collect()} == {"ok": (700, 699, 1, 0), "bad": (50, 50, 0, 0)}


def test_running_report_equals_the_batch_report_after_each_batch(spark):
    m, source, work = fx.event_messages(spark, SF_SMALL), scratch_path(spark, "messages"), scratch_path(spark, "stream")
    publish([m["body"].repartition(14)], source)
    out = run_stream_scoring(spark, source, work, fx.EVENT_FEATURES, live.EVENT_SCORER, ["label"], max_files_per_trigger=1)
    args = (spark, f"{work}/sink", out.sink.schema, f"{work}/running", f"{work}/running-checkpoint")
    assert follow(start_running_report(*args), work).finished
    assert running_report(spark, f"{work}/running").collect() == report_counts(out.sink).select(running_report(spark, f"{work}/running").columns).collect()
    publish([m["first"], m["redelivered"]], source)
    out = run_stream_scoring(spark, source, work, fx.EVENT_FEATURES, live.EVENT_SCORER, ["label"])
    assert follow(start_running_report(*args), work).finished
    kept = running_report(spark, f"{work}/running")
    assert kept.collect() == report_counts(out.sink).select(kept.columns).collect()
    assert spark.read.parquet(f"{work}/running").select("batch").distinct().count() <= KEPT_REPORTS + 1


def test_running_report_without_a_time_column(spark):
    scorer = live.EVENT_SCORER.__class__(intercept=10.0, weights={"V1": 0.001})
    m, source, work = fx.event_messages(spark, SF_SMALL), scratch_path(spark, "messages"), scratch_path(spark, "stream")
    publish([m["body"]], source)
    out = run_stream_scoring(spark, source, work, ["V1"], scorer)
    follow(start_running_report(spark, f"{work}/sink", out.sink.schema, f"{work}/running", f"{work}/rc"), work)
    kept = running_report(spark, f"{work}/running")
    assert kept.collect() == report_counts(out.sink).select(kept.columns).collect()


def test_a_failing_query_raises_its_error(spark):
    source, work = scratch_path(spark, "messages"), scratch_path(spark, "stream")
    publish([fx.event_messages(spark, SF_SMALL)["body"]], source)
    broken = message_stream(spark, source).withColumn("value", F.raise_error(F.lit("BROKEN_ON_PURPOSE")).cast("string"))
    with pytest.raises(Exception, match="BROKEN_ON_PURPOSE"):
        follow(start_sink(broken, f"{work}/sink", f"{work}/checkpoint"), work, 60)


def test_first_per_key_across_batches(spark):
    """Ties, nulls in key and order, a hot key, and keys that come again."""
    source, work = scratch_path(spark, "rows"), scratch_path(spark, "first")
    at = datetime(2024, 1, 1)
    schema = "k double, at timestamp, i long, s string"
    first = [(1.0, at, 5, "a"), (1.0, at, 3, "b"), (1.0, at, -4, "c"), (2.0, at, None, "d"), (None, at, 9, "e"), (None, at, 8, 'quote " |'), (float("nan"), at, 1, "n")]
    first += [(7.0, at + timedelta(microseconds=i % 977), i, "hot") for i in range(20_000)]
    second = [(1.0, at, -9, "late"), (2.0, at, 1, "late"), (3.0, at, 2**62, "z"), (3.0, at, -(2**62), "y"), (None, at, 1, "late")]
    got = []
    for rows in (first, second):
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        follow(start_sink(first_per_key(stream, "k", ["at", "i"]), f"{work}/sink", f"{work}/checkpoint"), work)
    got = {(str(r.k), r.i, r.s) for r in spark.read.parquet(f"{work}/sink").collect()}
    assert got == {("1.0", -4, "c"), ("2.0", None, "d"), ("None", 8, 'quote " |'), ("nan", 1, "n"), ("7.0", 0, "hot"), ("3.0", -(2**62), "y")}


def test_a_late_publisher_on_the_log(spark):
    """A live run that starts on an empty log ends soon after the sentinel."""
    m, log = fx.event_messages(spark, SF_SMALL), scratch_path(spark, "log")
    append_messages(m["body"].limit(0), log)
    publisher = threading.Thread(target=lambda: (time.sleep(2), append_messages(m["body"], log), append_messages(m["first"], log)))
    publisher.start()
    out = run_stream_scoring(
        spark, None, scratch_path(spark, "stream"), fx.EVENT_FEATURES, live.EVENT_SCORER, ["label"], live=True,
        max_runtime_seconds=90, processing_time="200 milliseconds", fmt=FORMAT, options={"path": log},
    )
    publisher.join()
    assert out.run.finished and out.report.first()["total_messages_seen"] == 1000
    assert all(json.loads(e)["by"] in ("rows", "delay") for e in out.run.end_offsets)
