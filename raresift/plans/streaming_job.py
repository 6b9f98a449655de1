"""The streaming scoring job: publish -> stream -> sink -> report (PAR2, PAR3).

``publish`` writes message deliveries as JSON-lines files (the encode job
of the publisher; pacing is not rebuilt).  ``run_stream_scoring`` runs the
streaming query over a message folder or bus until it has drained it (or
hit a run-time cap, if one is given), then builds the report from the sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from raresift.functions.scoring import LinearScorer
from raresift.operators.events import ID
from raresift.sinks.writers import write_document, write_messages
from raresift.streaming.lifecycle import StreamRun, with_kind_metrics
from raresift.streaming.report import REPORT_CAP, flagged_rows, stream_report
from raresift.streaming.scorer import (
    ARRIVED,
    dedupe_deliveries,
    message_stream,
    run_bounded,
    run_until_drained,
    score_messages,
    start_sink,
)


def publish(deliveries: Sequence[DataFrame], source_dir: str) -> str:
    """Append each delivery as its own set of files, in order (SNK5)."""
    for delivery in deliveries:
        write_messages(delivery, source_dir, mode="append")
    return source_dir


def read_sink(spark: SparkSession, sink_path: str, schema: StructType) -> DataFrame:
    """The committed sink, or an empty frame of the stream's schema if no batch committed."""
    try:
        return spark.read.schema(schema).parquet(sink_path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass
class ScoringOutput:
    run: StreamRun
    sink: DataFrame
    report: DataFrame
    flagged: DataFrame


def run_stream_scoring(
    spark: SparkSession,
    source: str | None,
    work_dir: str,
    feature_cols: Sequence[str],
    scorer: LinearScorer | PipelineModel,
    passthrough: Sequence[str] = (),
    max_files_per_trigger: int | None = None,
    max_runtime_seconds: float | None = None,
    report_path: str | None = None,
    dedupe_delay: str | None = None,
    live: bool = False,
    processing_time: str = "1 second",
    report_cap: int = REPORT_CAP,
    fmt: str = "text",
    options: dict[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
    max_batches: int | None = None,
) -> ScoringOutput:
    """Score every message of ``source`` into ``work_dir/sink``.

    With ``dedupe_delay`` redelivered ids are collapsed before the sink
    (DUP3); without it every delivery is kept, which is what the report's
    raw counters describe.  ``live`` runs a processing-time trigger until
    the sentinel has been seen and the source is drained; otherwise the run
    drains what is there (``availableNow``) and stops.  There is no run-time
    cap unless one is given; a run that it cuts has ``finished = false`` in
    its report.  ``report_path`` gets the document, and ``report_path`` +
    ``-flagged`` the complete list of flagged deliveries as a table.
    ``max_batches`` stops the run after so many batches; a later call with the
    same ``work_dir`` goes on from there.  ``fmt``, ``options`` and ``max_offsets_per_trigger`` read a message bus
    instead of a folder.
    """
    work = work_dir.rstrip("/")
    messages = message_stream(spark, source, max_files_per_trigger, fmt, options, max_offsets_per_trigger)
    stream = score_messages(messages, feature_cols, scorer, passthrough)
    if dedupe_delay:
        stream = dedupe_deliveries(stream, dedupe_delay)
    stream = with_kind_metrics(stream)
    sink_path = f"{work}/sink"
    query = start_sink(
        stream, sink_path, f"{work}/checkpoint", available_now=not live, processing_time=processing_time
    )
    follow = run_until_drained if live else run_bounded
    run = follow(query, sink_path, max_runtime_seconds, max_batches, spark)
    sink = read_sink(spark, sink_path, stream.schema)
    report = stream_report(sink, feature_cols, run.elapsed_seconds, report_cap, run.finished)
    flagged = flagged_rows(sink).select(ARRIVED, ID, *feature_cols, "prediction")
    if report_path:
        write_document(report, report_path)
        flagged.write.mode("overwrite").parquet(f"{report_path}-flagged")
    return ScoringOutput(run, sink, report, flagged)
