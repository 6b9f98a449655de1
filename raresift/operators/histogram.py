"""Score histograms: areas under the curves from counts that merge (AGG6, AGG7).

A histogram has one row per bin of a fixed grid, with the positives and
negatives whose score falls in it.  Histograms of any parts of the data
(partitions, micro-batches, days) add up to the histogram of the whole, so the
areas depend on the data alone, not on the layout.  What a grid loses is
stated: rows in one bin count as tied, and ``roc_error`` bounds how far the
exact area can be from the binned one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.operators.evaluate import areas_of_groups

#: Width of a bin; a probability then has a thousand bins.
WIDTH = 1 / 1000


def score_histogram(df: DataFrame, score: str, label: str = "label", width: float = WIDTH) -> DataFrame:
    """(bin, p, n): positives and negatives per bin of ``width``; null and NaN scores are left out."""
    value = F.col(score).cast("double")
    rows = df.select(value.alias("s"), (F.col(label) == 1).alias("pos")).filter("s IS NOT NULL AND NOT isnan(s)")
    bins = rows.groupBy(F.floor(F.col("s") / F.lit(width)).alias("bin"))
    return bins.agg(F.count_if("pos").alias("p"), F.count_if(~F.coalesce(F.col("pos"), F.lit(False))).alias("n"))


def merge_histograms(*histograms: DataFrame) -> DataFrame:
    """The histogram of all rows of some histograms on one grid."""
    rows = reduce(DataFrame.unionByName, histograms)
    return rows.groupBy("bin").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def histogram_areas(histogram: DataFrame) -> DataFrame:
    """One row: auc_roc, auc_pr, positives, negatives, bins and roc_error.

    The exact ROC area lies within ``roc_error`` of ``auc_roc``: the share of
    pairs of a positive and a negative in one bin, halved.  Areas and error are
    null without positives or without negatives.
    """
    groups = histogram.select(F.col("bin").cast("double").alias("_s"), F.col("p").cast("double").alias("p"), F.col("n").cast("double").alias("n"))
    shared = histogram.agg(
        F.try_divide(F.sum(F.col("p").cast("double") * F.col("n")), 2.0 * F.sum("p") * F.sum("n")).alias("roc_error"), F.count(F.lit(1)).alias("bins")
    )
    areas = areas_of_groups(groups, "_s")
    return areas.select("*", shared.select("bins").scalar().alias("bins"), shared.select("roc_error").scalar().alias("roc_error"))
