"""Streaming scorer (STR1-STR7, ML6, DUP3, SNK6, SNK7).

One Structured Streaming query replaces the hand-made consumer loop:

    readStream(messages) -> decode + route (kind) -> score -> append sink

* Micro-batches come from the trigger (``processingTime`` for a live
  service, ``availableNow`` for a bounded run that drains what is there
  and stops); ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` bound a
  batch if given (STR1).
* State across batches is the sink itself — every delivery is appended
  with its ``kind``, score and decision, so counters and the flagged list
  are batch aggregates over the sink, never driver memory (STR3, SNK7).
* Offsets and the sink's commit log live in the checkpoint folder: after a
  crash the query resumes where the last committed batch ended and the
  file sink never duplicates a batch (STR6).
* The sentinel is routed like any other row and does not stop the query:
  a message delivered after it is still scored (STR4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from raresift.functions.expressions import alert_text
from raresift.functions.scoring import LinearScorer
from raresift.operators.events import ID, decode_messages, once
from raresift.sources.message_log import FORMAT as LOG_FORMAT
from raresift.sources.message_log import register_message_log
from raresift.streaming.lifecycle import StreamRun, follow

ARRIVED = "arrived_at"
SOURCE_FILE = "source_file"


def message_stream(
    spark: SparkSession,
    source: str | None,
    max_files_per_trigger: int | None = None,
    fmt: str = "text",
    options: dict[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of raw messages (SRC4).

    Each row carries its ``value`` text, where it came from and the
    processing time of its micro-batch (``arrived_at``).  File formats read a
    folder of JSON-lines files; any other format (``kafka`` with its
    ``subscribe``/bootstrap options, for one) is read with ``options`` and
    only needs a ``value`` column.  Batches are unbounded unless a limit is
    given; a bus takes ``minOffsetsPerTrigger`` and ``maxTriggerDelay`` (a
    batch at so many rows or after so long) as ``options``, the message log
    of this package ``minRows`` and ``maxDelay``.
    """
    if fmt == LOG_FORMAT:
        register_message_log(spark)
    reader = spark.readStream.format(fmt).options(**(options or {}))
    file_source = fmt in ("text", "json", "csv", "parquet")
    if file_source and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if not file_source and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    raw = reader.load(source) if source else reader.load()
    # a bus names a delivery by its place in the log
    places = [F.col(c).cast("string") for c in ("topic", "partition", "offset") if c in raw.columns]
    origin = F.col("_metadata.file_name") if file_source else F.concat_ws("-", F.lit(fmt), *places)
    return raw.select(
        F.col("value").cast("string").alias("value"),
        origin.alias(SOURCE_FILE),
        F.current_timestamp().alias(ARRIVED),
    )


def _score_columns(decoded: DataFrame, scorer, feature_cols: Sequence[str]) -> DataFrame:
    ok = F.col("kind") == F.lit("ok")
    if isinstance(scorer, LinearScorer):
        scored = once(decoded, "probability", F.when(ok, scorer.probability()))
        return scored.select("*", F.when(ok, scorer.prediction(F.col("probability"))).alias("prediction"))
    if isinstance(scorer, PipelineModel):
        # Rejected rows still flow through the model (their vectors get
        # NaN instead of raising); their outputs are masked below.  The
        # caller's model is left as it is: a copy of the assembler is used.
        stages = [
            s.copy().setHandleInvalid("keep") if isinstance(s, VectorAssembler) else s for s in scorer.stages
        ]
        scored = PipelineModel(stages).transform(decoded)
        return scored.select(
            *decoded.columns,
            F.when(ok, vector_to_array(F.col("probability"))[1]).alias("probability"),
            F.when(ok, F.col("prediction")).alias("prediction"),
        )
    raise TypeError(f"unsupported scorer {type(scorer).__name__}")


def score_messages(
    messages: DataFrame,
    feature_cols: Sequence[str],
    scorer: LinearScorer | PipelineModel,
    passthrough: Sequence[str] = (),
    time_col: str = "Time",
    amount_col: str = "Amount",
) -> DataFrame:
    """Decode, route and score every message; batch or streaming (STR2, ML6, FLT2).

    Output: arrival columns, ``__id``, ``kind``, ``reason``, features,
    passthrough fields, ``total_published``, ``probability`` and
    ``prediction`` (null unless ``kind = 'ok'``), the live ``alert`` text of a
    flagged row (SNK6; null for a model without the two notice columns) and
    the original ``value`` of a rejected one.
    """
    keep = [c for c in (ARRIVED, SOURCE_FILE) if c in messages.columns]
    decoded = decode_messages(messages, feature_cols, passthrough, keep=keep)
    scored = _score_columns(decoded, scorer, feature_cols)
    rejected = F.col("kind").isin("bad", "invalid")
    notice = F.lit(None).cast("string")
    if {time_col, amount_col} <= set(scored.columns):
        notice = F.when(F.col("prediction") == 1.0, alert_text(time_col, amount_col))
    return scored.select(
        *[c for c in scored.columns if c != "value"],
        notice.alias("alert"),
        F.when(rejected, F.col("value")).alias("value"),
    )


def dedupe_deliveries(scored: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Collapse redelivered messages by ``__id`` within a watermark (DUP3).

    The delay must exceed the longest redelivery gap of the source (the
    bus's ack deadline plus retries).  Messages without an id are keyed by a
    digest of their text, so distinct junk lines are not merged.  State is
    bounded: keys older than the watermark are evicted.
    """
    key = F.coalesce(F.col(ID).cast("string"), F.concat(F.lit("raw:"), F.sha2(F.coalesce(F.col("value"), F.col("kind")), 256)))
    return (
        scored.withColumn("_dedup_key", key)
        .withWatermark(ARRIVED, delay)
        .dropDuplicatesWithinWatermark(["_dedup_key"])
        .drop("_dedup_key")
    )


def start_sink(
    df: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str = "1 second",
    query_name: str | None = None,
) -> StreamingQuery:
    """Append to a parquet folder with an exactly-once commit log (SNK7, STR6)."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def run_bounded(
    query: StreamingQuery, sink_path: str, max_runtime_seconds: float | None = None, max_batches: int | None = None, spark: SparkSession | None = None
) -> StreamRun:
    """Wait for a bounded query to read all there is (STR5, STR7), see :func:`follow`."""
    return follow(query, sink_path, max_runtime_seconds, max_batches=max_batches, spark=spark)


def run_until_drained(
    query: StreamingQuery, sink_path: str, max_runtime_seconds: float | None = None, max_batches: int | None = None, spark: SparkSession | None = None
) -> StreamRun:
    """Run a live query until the sentinel has been seen and the source is drained.

    The end condition of the original consumer ("sentinel arrived and the
    buffer is empty"): once a batch has held the sentinel, the query stops at
    the first later report that brings no new rows.  Messages that arrive
    after the sentinel but before the drain are still scored (STR4, STR5, STR7),
    see :func:`follow`.
    """
    return follow(query, sink_path, max_runtime_seconds, until_drained=True, max_batches=max_batches, spark=spark)
