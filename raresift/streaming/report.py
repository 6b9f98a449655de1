"""Report over the scored sink (AGG8-AGG13, LIM2, SNK4, DUP2, PRJ8, PRJ9).

The report is a batch query over what the streaming query appended; it
is a single row built from one aggregate plus scalar subqueries, so it
scales with the sink and never gathers unbounded rows: the flagged list is
a top-``cap`` (TakeOrderedAndProject) before it is collected into an array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresift.operators.events import ID, TOTAL_FIELD

# Fixed value: most flagged rows listed in one report (the count is not
# capped, and the complete list is written as a table beside the document).
REPORT_CAP = 100
ARRIVED = "arrived_at"


def flagged_rows(sink: DataFrame) -> DataFrame:
    """All flagged deliveries."""
    return sink.filter(F.col("prediction") == 1.0)


def arrival_order(sink: DataFrame) -> list[Column]:
    """Arrival (the micro-batch's time), then publish order."""
    return ([F.col(ARRIVED)] if ARRIVED in sink.columns else []) + [F.col(ID).asc_nulls_last()]


def _distinct(df: DataFrame, column: str) -> Column:
    """How many values a column takes, as a scalar subquery: distinct rows, then a count."""
    return df.select(column).distinct().agg(F.count(column)).scalar()


def report_counts(sink: DataFrame, time_col: str = "Time") -> DataFrame:
    """One row of delivery counters (AGG8-AGG11).

    ``total_messages_seen`` counts every non-sentinel delivery, duplicates
    and rejects included; ``frauds_flagged_count`` counts flagged
    deliveries.  Distinct counts on the time column (null without one) and on
    ``__id`` show how many of those are redeliveries, and ``complete`` says
    whether every published id arrived.  Each distinct count is an aggregate
    of its own over the rows it needs, so no row is copied for it.
    """
    data = F.col("kind") != F.lit("sentinel")
    flagged = flagged_rows(sink)
    times = F.lit(None).cast("long")
    if time_col in sink.columns:
        times = _distinct(flagged, time_col)
    return (
        sink.agg(
            F.count_if(data).alias("total_messages_seen"),
            F.max(TOTAL_FIELD).alias("sentinel_total_published"),
            F.count_if(F.col("prediction") == F.lit(1.0)).alias("frauds_flagged_count"),
            F.count_if(F.col("kind") == "ok").alias("scored_messages"),
            F.count_if(F.col("kind") == "invalid").alias("invalid_messages"),
            F.count_if(F.col("kind") == "bad").alias("bad_messages"),
        )
        .withColumn("frauds_distinct_time", times)
        .withColumn("frauds_distinct_id", _distinct(flagged, ID))
        .withColumn("distinct_ids_seen", _distinct(sink.filter(data), ID))
        .withColumn(
            "complete",
            F.coalesce(F.col("distinct_ids_seen") == F.col("sentinel_total_published"), F.lit(False)),
        )
    )


def stream_report(
    sink: DataFrame,
    feature_cols: Sequence[str],
    elapsed_seconds: float | None = None,
    cap: int = REPORT_CAP,
    finished: bool = True,
) -> DataFrame:
    """The full report document as one row (SNK4).

    ``frauds`` holds the first ``cap`` flagged deliveries in arrival order
    (LIM2, PRJ6); ``finished`` is False for a run that its cap cut.
    """
    fields = [ID, *feature_cols, "prediction"]
    order = [ARRIVED] if ARRIVED in sink.columns else []
    top = flagged_rows(sink).orderBy(*arrival_order(sink)).limit(cap).select(*order, *fields)
    listed = F.array_sort(F.collect_list(F.struct(*order, *fields)))
    frauds = top.agg(F.transform(listed, lambda f: F.struct(*[f[c].alias(c) for c in fields]))).scalar()
    return report_counts(sink).select(
        "*",
        frauds.alias("frauds"),
        F.lit(bool(finished)).alias("finished"),
        F.lit(None if elapsed_seconds is None else round(float(elapsed_seconds), 2)).cast("double").alias("elapsed_seconds"),
    )


def unique_by(df: DataFrame, key: str, position: Sequence[str]) -> DataFrame:
    """First row per ``key`` (smallest by the ``position`` columns), ordered by ``key`` (DUP2).

    An aggregate, not a window: ``min_by`` combines map-side, so a key
    holding a third of the rows is reduced per task before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct(*position)).alias("_first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"_first.{c}").alias(c) for c in others]).orderBy(key)


def report_frauds(report: DataFrame, fields: Sequence[str] = ("Time", "Amount", "prediction")) -> DataFrame:
    """Explode the report's flagged list into rows with their array position (PRJ8)."""
    return report.select(F.posexplode("frauds").alias("pos", "f")).select(
        "pos", *[F.col(f"f.{c}").alias(c) for c in fields]
    )
