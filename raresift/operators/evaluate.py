"""Evaluation of scored rows (AGG5-7, LIM1, ORD2, PRJ5).

All metrics are DataFrames.  The exact areas use the distributed running
sum of :mod:`raresift.operators.cumulative`; Spark's
``BinaryClassificationEvaluator`` is kept for the training summary, where a
driver-side number is what is wanted.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.functions.schema import LABEL
from raresift.operators.cumulative import running_totals


def confusion_matrix(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Counts by (label, prediction), long form, ordered (AGG5, ORD2).

    Pairs that never occur stay absent, as in a plain GROUP BY.
    """
    return (
        df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("label", "prediction")
    )


def binary_areas(
    df: DataFrame,
    score: str,
    label: str = LABEL,
    num_buckets: int | None = None,
) -> DataFrame:
    """Exact area under the ROC and PR curves, one row (AGG6, AGG7).

    Rows are grouped by score (ties share a point), cumulative positives
    ``tp`` and negatives ``fp`` are taken in descending score order, and

    * ROC: ``sum(p * (N - fp + n/2)) / (P*N)`` — each positive beats the
      negatives below it and half of those tied with it;
    * PR: trapezoids between consecutive (recall, precision) points, the
      first point preceded by (0, its own precision); the previous point of
      a group is its own cumulative counts minus the group, so no lag.

    Both equal ``BinaryClassificationEvaluator(numBins=0)``.  Null scores are
    ignored; with no positives or no negatives the areas are null.
    """
    rows = df.select(
        F.col(score).cast("double").alias("_s"),
        (F.col(label) == 1).alias("_pos"),
    ).filter(F.col("_s").isNotNull())
    groups = rows.groupBy("_s").agg(
        F.count_if(F.col("_pos")).cast("double").alias("p"),
        F.count_if(~F.col("_pos")).cast("double").alias("n"),
    )
    return areas_of_groups(groups, "_s", num_buckets, rows)


def areas_of_groups(groups: DataFrame, score: str, num_buckets: int | None = None, quantile_source: DataFrame | None = None) -> DataFrame:
    """The areas of :func:`binary_areas` from distinct scores with their positives ``p`` and negatives ``n`` (doubles)."""
    cum = running_totals(
        groups, score, ["p", "n"], descending=True, prefix="c_", num_buckets=num_buckets, quantile_source=quantile_source
    )
    tp, fp, p, n = F.col("c_p"), F.col("c_n"), F.col("p"), F.col("n")
    precision = tp / (tp + fp)
    prev_tp, prev_fp = tp - p, fp - n
    prev_precision = F.when(prev_tp + prev_fp == 0, precision).otherwise(prev_tp / (prev_tp + prev_fp))
    agg = cum.agg(
        F.sum(p).alias("P"),
        F.sum(n).alias("N"),
        F.sum(p * fp).alias("A"),
        F.sum(p * n).alias("C"),
        F.sum(p * (precision + prev_precision) / 2).alias("R"),
    )
    pn = F.col("P") * F.col("N")
    return agg.select(
        F.try_divide(pn - F.col("A") + F.col("C") / 2, pn).alias("auc_roc"),
        F.try_divide(F.col("R"), F.col("P")).alias("auc_pr"),
        F.col("P").cast("long").alias("positives"),
        F.col("N").cast("long").alias("negatives"),
    )


def evaluator_areas(
    predictions: DataFrame,
    label: str = LABEL,
    raw_prediction: str = "rawPrediction",
    num_bins: int = 1000,
    class_counts: tuple[int, int] | None = None,
) -> tuple[float, float]:
    """(AUC-ROC, AUC-PR) from MLlib's evaluator, as the training job reports them.

    The evaluator fails on a set with one class only; that case gives NaN
    areas instead.  ``class_counts`` (positives, negatives), when the caller
    already has them, saves the bounded counting pass.
    """
    if class_counts is None:
        row = predictions.agg(
            F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")
        ).first()
        class_counts = (row["p"], row["n"])
    if not class_counts[0] or not class_counts[1]:
        return float("nan"), float("nan")
    roc = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw_prediction, metricName="areaUnderROC", numBins=num_bins
    ).evaluate(predictions)
    pr = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw_prediction, metricName="areaUnderPR", numBins=num_bins
    ).evaluate(predictions)
    return float(roc), float(pr)


def sample_predictions(
    df: DataFrame,
    order_key: str,
    n: int = 50,
    label: str = LABEL,
    prediction: str = "prediction",
) -> DataFrame:
    """First ``n`` scored rows by ``order_key`` as ints (LIM1, PRJ3, PRJ5).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task
    keeps its own top ``n``, so only ``n`` rows per task move.
    """
    return (
        df.orderBy(order_key)
        .limit(n)
        .select(order_key, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
    )
