"""The scored sink as a table partitioned by kind and batch day (SNK7, FLT2, AGG9).

A stream leaves one small file per task and batch.  Compaction rewrites what
the sink has committed into folders by kind and by the day of arrival, with
few files each, so a reader of flagged rows or of one day opens those files
only.  It replaces whole folders: running it again, or again after a crash,
gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresift.streaming.scorer import ARRIVED

KIND, DAY = "kind", "arrived_day"
#: Rows of a file, at most.
FILE_ROWS = 2_000_000


def compact_sink(sink: DataFrame, path: str, days: Sequence[str] | None = None, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write the sink's rows into ``path``/kind=.../arrived_day=... and read the table back.

    ``days`` (as ``yyyy-mm-dd``) limits the work to some days; only their
    folders are replaced.  Rows are spread over a folder's files by adaptive
    rebalancing, so a kind that holds nearly all rows is not one task's.
    """
    spark = sink.sparkSession
    dated = sink.withColumn(DAY, F.to_date(ARRIVED))
    if days is not None:
        dated = dated.filter(F.col(DAY).isin(*[F.lit(d).cast("date") for d in days]))
    spread = dated.hint("rebalance", KIND, DAY)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", file_rows)
        .partitionBy(KIND, DAY)
        .parquet(path)
    )
    return read_compacted(spark, path, sink)


def read_compacted(spark: SparkSession, path: str, sink: DataFrame) -> DataFrame:
    """The compacted table with the sink's columns, and ``arrived_day``; filters on kind and day prune folders."""
    return spark.read.parquet(path).select(*sink.columns, DAY)
