import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from conftest import SF_SMALL
from raresift.operators.model import fit_classifier, load_model, save_model, score
from raresift.operators.profile import with_class_weight
from raresift.functions.scoring import LinearScorer
from raresift.plans.queries import EVENT_SCORER, complete, published_events
from raresift.plans.streaming_job import publish, read_sink, run_stream_scoring
from raresift.session import scratch_path
from raresift.sources import fixtures as fx
from raresift.streaming.report import REPORT_CAP
from raresift.streaming.scorer import message_stream, run_bounded, score_messages, start_sink


def repeats(spark):
    return fx.event_messages(spark, SF_SMALL)["redelivered"].count()


def test_stream_equals_batch_with_saved_model(spark):
    ev = fx.event_features(spark, SF_SMALL)
    model = fit_classifier(with_class_weight(ev.drop(fx.EVENT_KEY)), fx.EVENT_FEATURES, label="label")
    loaded = load_model(save_model(model, scratch_path(spark, "event-model")))
    src = published_events(spark, SF_SMALL)
    out = run_stream_scoring(spark, src, scratch_path(spark, "stream-model"), fx.EVENT_FEATURES, loaded, ["label"])
    streamed = {r[fx.EVENT_KEY]: r["prediction"] for r in out.sink.filter("kind = 'ok'").collect()}
    day = ev.withColumn("Time", F.floor(F.col("Time") / fx.MESSAGE_TIME_STEP) * float(fx.MESSAGE_TIME_STEP))
    batch = score(model, day).select(fx.EVENT_KEY, "prediction")
    want = {r[0]: r[1] for r in batch.collect()}
    assert streamed and all(want[k] == v for k, v in streamed.items())


def test_sentinel_first_does_not_end_run(spark):
    out = run_stream_scoring(
        spark, published_events(spark, SF_SMALL), scratch_path(spark, "stream-order"),
        fx.EVENT_FEATURES, EVENT_SCORER, ["label"],
    )
    rep = out.report.first()
    assert rep["total_messages_seen"] == 1000 + repeats(spark)
    assert rep["sentinel_total_published"] == 1000
    assert rep["bad_messages"] == 3 and rep["invalid_messages"] == 4
    assert rep["complete"] is False  # three undecodable messages carry no id
    assert out.run.finished and rep["finished"] is True
    assert out.run.input_rows == 1000 + repeats(spark) + 1
    assert rep["frauds_distinct_time"] < rep["frauds_distinct_id"] < rep["frauds_flagged_count"]


def test_report_caps_list_not_count(spark):
    flag_all = LinearScorer(intercept=10.0, weights={}, threshold=0.7)
    out = run_stream_scoring(
        spark, published_events(spark, SF_SMALL), scratch_path(spark, "stream-cap"),
        fx.EVENT_FEATURES, flag_all, ["label"],
    )
    rep = out.report.first()
    assert rep["frauds_flagged_count"] == 1000 - 7 + repeats(spark)
    assert len(rep["frauds"]) == REPORT_CAP
    assert [f["__id"] for f in rep["frauds"]] == sorted(f["__id"] for f in rep["frauds"])
    assert rep["frauds_distinct_id"] == 1000 - 7
    assert rep["elapsed_seconds"] > 0


def test_dedupe_collapses_redeliveries(spark):
    out = run_stream_scoring(
        spark, published_events(spark, SF_SMALL), scratch_path(spark, "stream-dedup"),
        fx.EVENT_FEATURES, EVENT_SCORER, ["label"], dedupe_delay="10 minutes",
    )
    ids = out.sink.filter(F.col(fx.EVENT_KEY).isNotNull()).groupBy(fx.EVENT_KEY).count()
    assert ids.filter("count > 1").count() == 0
    assert out.sink.filter("kind = 'bad'").count() == 3


def test_runtime_cap_stops_live_query(spark):
    src = published_events(spark, SF_SMALL)
    work = scratch_path(spark, "stream-live")
    stream = score_messages(message_stream(spark, src), fx.EVENT_FEATURES, EVENT_SCORER, ["label"])
    q = start_sink(stream, f"{work}/sink", f"{work}/ckpt", available_now=False, processing_time="1 second")
    t0 = time.time()
    run = run_bounded(q, f"{work}/sink", max_runtime_seconds=8)
    assert not run.finished and not q.isActive
    assert time.time() - t0 < 60


def test_restart_resumes_from_checkpoint(spark):
    """A second run over the same checkpoint only reads new files."""
    m = fx.event_messages(spark, SF_SMALL)
    src = publish([m["body"]], scratch_path(spark, "messages-restart"))
    work = scratch_path(spark, "stream-restart")

    def once():
        stream = score_messages(message_stream(spark, src), fx.EVENT_FEATURES, EVENT_SCORER, ["label"])
        return run_bounded(start_sink(stream, f"{work}/sink", f"{work}/ckpt"), f"{work}/sink", 120)

    once()
    first = spark.read.parquet(f"{work}/sink").count()
    publish([m["redelivered"]], src)
    once()
    second = spark.read.parquet(f"{work}/sink").count()
    assert first == 1000 and second == 1000 + repeats(spark)


def many_files(spark):
    m = fx.event_messages(spark, SF_SMALL)
    return publish([m["first"], m["body"].repartition(44)], scratch_path(spark, "messages-many"))


def test_a_cut_run_says_so(spark):
    out = run_stream_scoring(
        spark, many_files(spark), scratch_path(spark, "stream-cut"), fx.EVENT_FEATURES, EVENT_SCORER, ["label"],
        max_files_per_trigger=1, max_runtime_seconds=5,
    )
    rep = out.report.first()
    assert not out.run.finished and rep["finished"] is False
    assert rep["total_messages_seen"] < 1000
    with pytest.raises(RuntimeError, match="STREAM_CUT"):
        complete(out)


def test_many_files_without_a_limit_are_one_complete_run(spark):
    out = run_stream_scoring(
        spark, many_files(spark), scratch_path(spark, "stream-many"), fx.EVENT_FEATURES, EVENT_SCORER, ["label"]
    )
    assert out.run.finished and out.report.first()["total_messages_seen"] == 1000
    assert out.run.batches == 1


def test_more_batches_than_spark_reports(spark):
    """Batch figures hold beyond the progress reports that Spark keeps."""
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10")
    try:
        out = run_stream_scoring(
            spark, many_files(spark), scratch_path(spark, "stream-batches"), fx.EVENT_FEATURES, EVENT_SCORER, ["label"],
            max_files_per_trigger=1,
        )
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert out.run.batches >= 40 and out.run.input_rows == 1001


def test_live_run_sees_a_sentinel_after_idling(spark):
    """The consumer starts on an empty folder; messages and the sentinel come later."""
    m = fx.event_messages(spark, SF_SMALL)
    src = publish([m["body"].limit(0)], scratch_path(spark, "messages-late"))
    work = scratch_path(spark, "stream-late")

    def later():
        time.sleep(14)
        publish([m["body"], m["first"]], src)

    publisher = threading.Thread(target=later)
    publisher.start()
    started = time.time()
    out = run_stream_scoring(
        spark, src, work, fx.EVENT_FEATURES, EVENT_SCORER, ["label"], live=True, max_runtime_seconds=180
    )
    publisher.join()
    rep = out.report.first()
    assert out.run.finished and time.time() - started < 120
    assert rep["total_messages_seen"] == 1000 and rep["sentinel_total_published"] == 1000


def test_broken_sink_is_an_error(spark):
    path = scratch_path(spark, "broken-sink")
    spark.createDataFrame([("not parquet",)], "value string").write.text(path)
    with pytest.raises(Exception):
        read_sink(spark, path, StructType([StructField("kind", StringType())])).count()


def test_model_without_notice_columns(spark):
    scorer = LinearScorer(intercept=10.0, weights={"V1": 0.001})
    out = run_stream_scoring(spark, published_events(spark, SF_SMALL), scratch_path(spark, "stream-v1"), ["V1"], scorer)
    rep = out.report.first()
    assert rep["frauds_distinct_time"] is None and rep["frauds_flagged_count"] > 0
    assert out.sink.filter("alert IS NOT NULL").count() == 0


def test_bus_options_reach_the_source(spark):
    """A bus takes its limits as source options (a rate source stands in for one)."""
    stream = message_stream(
        spark, None, fmt="rate", options={"rowsPerSecond": "5"}, max_offsets_per_trigger=10
    )
    assert stream.isStreaming and stream.columns == ["value", "source_file", "arrived_at"]


def test_live_run_stops_after_sentinel_and_drain(spark):
    out = run_stream_scoring(
        spark, published_events(spark, SF_SMALL), scratch_path(spark, "stream-live-drain"),
        fx.EVENT_FEATURES, EVENT_SCORER, ["label"], live=True, max_runtime_seconds=120,
    )
    rep = out.report.first()
    assert out.run.finished
    assert rep["total_messages_seen"] == 1000 + repeats(spark)
    assert rep["sentinel_total_published"] == 1000


def test_fit_after_an_observed_stream(spark):
    """Observed stream metrics must not break later MLlib jobs in the session."""
    run_stream_scoring(
        spark, published_events(spark, SF_SMALL), scratch_path(spark, "stream-then-fit"),
        fx.EVENT_FEATURES, EVENT_SCORER, ["label"],
    )
    ev = fx.event_features(spark, SF_SMALL)
    model = fit_classifier(with_class_weight(ev.drop(fx.EVENT_KEY)), fx.EVENT_FEATURES, label="label")
    assert score(model, ev).count() == ev.count()


def test_empty_source_gives_an_empty_report(spark):
    ev = fx.event_features(spark, SF_SMALL).limit(0)
    from raresift.operators.events import encode_messages

    src = publish([encode_messages(ev, fx.EVENT_KEY)], scratch_path(spark, "messages-empty"))
    out = run_stream_scoring(spark, src, scratch_path(spark, "stream-empty"), fx.EVENT_FEATURES, EVENT_SCORER)
    rep = out.report.first()
    assert rep["total_messages_seen"] == 0 and rep["frauds"] == [] and rep["complete"] is False
    assert rep["sentinel_total_published"] is None
