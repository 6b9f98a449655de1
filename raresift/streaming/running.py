"""The report's counters kept up to date by streaming state (STR3, AGG8-AGG10).

A second streaming query reads what the scoring query has committed to its
sink and aggregates it statefully: one state row per kind, per id, and per
flagged time and id.  After each batch only the changed state rows come out;
``foreachBatch`` folds them into the report of the batch before and writes the
result under the batch's id.  So a report costs the new rows only, never a
scan of the sink, and a batch that runs again after a crash overwrites its own
report with the same numbers.

Exact distinct counts need a state row per distinct value; it lies in the
state store, split over the shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from raresift.operators.events import ID, TOTAL_FIELD

#: Reports of so many batches are kept.
KEPT_REPORTS = 10
BATCH = "batch"

#: Counters that only grow: the newest value is the largest.
TOTALS = {"scored_messages": "ok", "invalid_messages": "invalid", "bad_messages": "bad"}
#: Counters of distinct values: each batch adds the values it has seen first.
DISTINCTS = {"frauds_distinct_time": "flagged_time", "frauds_distinct_id": "flagged_id", "distinct_ids_seen": "id"}


def _facets(time_col: str | None) -> Column:
    flagged = F.col("prediction") == 1.0

    def facet(name: str, key: Column, when: Column) -> Column:
        return F.when(when & key.isNotNull(), F.struct(F.lit(name).alias("facet"), key.cast("string").alias("key")))

    out = [
        facet("kind", F.col("kind"), F.lit(True)),
        facet("flagged", F.lit(""), flagged),
        facet("id", F.col(ID), F.col("kind") != "sentinel"),
        facet("flagged_id", F.col(ID), flagged),
    ]
    if time_col:
        out.append(facet("flagged_time", F.col(time_col), flagged))
    return F.array_compact(F.array(*out))


def counted_state(sink: DataFrame, time_col: str | None = "Time") -> DataFrame:
    """State rows of a stream of scored rows: (facet, key), how often, first and last batch time, published total."""
    rows = sink.select(F.explode(_facets(time_col)).alias("f"), F.col(TOTAL_FIELD), F.current_timestamp().alias("seen"))
    return rows.groupBy("f.facet", "f.key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("seen").alias("first"),
        F.max("seen").alias("last"),
        F.max(TOTAL_FIELD).alias("published"),
    )


def _change(changed: DataFrame, with_time: bool) -> DataFrame:
    """One row: totals as of this batch (null if unchanged), and how many distinct values are new in it."""
    new = F.col("first") == F.col("last")
    totals = [F.max(F.when((F.col("facet") == "kind") & (F.col("key") == kind), F.col("n"))).alias(name) for name, kind in TOTALS.items()]
    flagged = F.max(F.when(F.col("facet") == "flagged", F.col("n"))).alias("frauds_flagged_count")
    distinct = [F.count_if((F.col("facet") == facet) & new).alias(name) for name, facet in DISTINCTS.items()]
    if not with_time:
        distinct[0] = F.lit(None).cast("long").alias("frauds_distinct_time")
    return changed.agg(*totals, flagged, F.max("published").alias("sentinel_total_published"), *distinct)


def _reports(spark: SparkSession, path: str) -> DataFrame:
    names = [*TOTALS, "frauds_flagged_count", "sentinel_total_published", *DISTINCTS]
    fields = reduce(lambda s, n: s.add(n, "long"), names, StructType())
    return spark.read.schema(fields.add(BATCH, "long")).option("basePath", path).parquet(f"{path}/{BATCH}=*")


def _drop_older(spark: SparkSession, path: str, batch: int) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) < batch - KEPT_REPORTS:
            files.delete(status.getPath(), True)


def _has_reports(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{BATCH}=*")))


def start_running_report(
    spark: SparkSession,
    sink_path: str,
    schema: StructType,
    report_path: str,
    checkpoint_path: str,
    time_col: str | None = "Time",
    available_now: bool = True,
    processing_time: str = "1 second",
) -> StreamingQuery:
    """Start the query that keeps ``report_path`` up to date with the sink.

    Only files that the sink's log has committed are read.
    """
    names = {f.name for f in schema.fields}
    time_col = time_col if time_col in names else None

    def fold(changed: DataFrame, batch: int) -> None:
        session = changed.sparkSession
        merged = _change(changed, time_col is not None)
        if _has_reports(session, report_path):
            before = _reports(session, report_path).filter(F.col(BATCH) < batch).orderBy(F.col(BATCH).desc()).limit(1)
            merged = merged.unionByName(before.drop(BATCH))
        largest = [F.max(c).alias(c) for c in (*TOTALS, "frauds_flagged_count", "sentinel_total_published")]
        merged = merged.agg(*largest, *[F.sum(c).alias(c) for c in DISTINCTS])
        merged.coalesce(1).write.mode("overwrite").parquet(f"{report_path}/{BATCH}={batch}")
        _drop_older(session, report_path, batch)

    state = counted_state(spark.readStream.schema(schema).parquet(sink_path), time_col)
    writer = state.writeStream.outputMode("update").foreachBatch(fold).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def running_report(spark: SparkSession, report_path: str) -> DataFrame:
    """The newest report: the columns of ``report_counts``, one row (none before the first batch)."""
    newest = _reports(spark, report_path).orderBy(F.col(BATCH).desc()).limit(1)
    zero: Sequence[str] = (*TOTALS, "frauds_flagged_count")
    filled = newest.select("sentinel_total_published", *DISTINCTS, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in zero])
    return filled.select(
        (F.col("scored_messages") + F.col("invalid_messages") + F.col("bad_messages")).alias("total_messages_seen"),
        "sentinel_total_published",
        *zero[3:],
        *zero[:3],
        *DISTINCTS,
        F.coalesce(F.col("distinct_ids_seen") == F.col("sentinel_total_published"), F.lit(False)).alias("complete"),
    )
