"""The training job: clean -> profile -> weight -> split -> fit -> evaluate -> document (PAR1).

Parameters are keyword arguments (``python -m raresift train`` maps its flags
onto them).  The summary is a one-row DataFrame whose nested
arrays come from scalar subqueries, written with a Spark JSON sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresift.functions.expressions import DECISION_THRESHOLD, MAX_ITER, SEED, TRAIN_FRACTION, hash_key
from raresift.functions.schema import LABEL, TARGET, WEIGHT, feature_columns
from raresift.operators.clean import COPIES, clean_tally, sample_rows, tally_counts, tally_rows
from raresift.operators.evaluate import binary_areas, confusion_matrix, evaluator_areas, sample_predictions
from raresift.operators.model import fit_classifier, save_model, score
from raresift.operators.persist import discard, materialize
from raresift.operators.profile import class_profile, with_class_weight
from raresift.operators.split import split_flag
from raresift.sinks.writers import write_document, write_sample_csv


#: Column of the written rows: 'train' or 'test'.
SIDE = "_side"


def _round4(x: float | None) -> float | None:
    return None if x is None else round(float(x), 4)


@dataclass
class TrainingResult:
    model: PipelineModel
    feature_cols: list[str]
    summary: DataFrame
    predictions: DataFrame
    area_under_roc: float
    area_under_pr: float


def run_training(
    spark: SparkSession,
    raw: DataFrame,
    dataset_path: str = "",
    output_dir: str | None = None,
    model_output_dir: str | None = None,
    key: Sequence[str] | None = None,
    max_iter: int = MAX_ITER,
    sample_fraction: float = 1.0,
    decision_threshold: float = DECISION_THRESHOLD,
    train_fraction: float = TRAIN_FRACTION,
    seed: int = SEED,
    target: str = TARGET,
    num_bins: int = 1000,
    view: str = "transactions",
    sample_size: int = 50,
) -> TrainingResult:
    """Train and evaluate on ``raw`` (a table with a 0/1 ``target`` column).

    ``key`` names columns that identify a row (excluded from the features);
    without it the split hashes every column of the cleaned row, which is
    unique after de-duplication.
    """
    key = list(key or [])
    # Hash sample on the key (or on the whole row): reproducible on any
    # layout, and copies of a row are kept or dropped together.
    working = sample_rows(raw, sample_fraction, seed, key=key or list(raw.columns))
    # One pass over the input: the distinct complete rows with their copy
    # counts and their side of the split are written once to the shared
    # checkpoint folder, and every later step (weights, profile, fit, metrics)
    # reads that table; the fit reads the features and the side only.
    counted = tally_rows(working)
    side = split_flag(hash_key(key if key else [c for c in counted.columns if c != COPIES]), train_fraction, seed)
    tally = materialize(counted.withColumn(SIDE, side), "tally")
    totals = tally_counts(tally, target).first()
    flagged = clean_tally(tally, target, LABEL)
    clean = flagged.drop(SIDE)
    counts = (totals["rows_after_cleaning"], totals["positives"])
    weighted = with_class_weight(clean, LABEL, WEIGHT, counts)
    profile = class_profile(spark, clean, view)

    features = feature_columns(weighted, exclude=(LABEL, WEIGHT), extra_exclude=key)
    split_key = hash_key(key if key else [c for c in clean.columns])
    order_key = "_sample_key"
    flagged = with_class_weight(flagged, LABEL, WEIGHT, counts)
    # The optimiser caches its own blocks of the training rows.
    train = flagged.filter(F.col(SIDE) == "train").select(*features, LABEL, WEIGHT)
    model = fit_classifier(train, features, max_iter=max_iter, threshold=decision_threshold)
    if model_output_dir:
        save_model(model, model_output_dir)

    # Only what the metrics and the sample read is written, once.
    test = flagged.filter(F.col(SIDE) == "test").drop(SIDE).withColumn(order_key, split_key)
    scored = score(model, test).select(order_key, *key, LABEL, "prediction", "rawPrediction", "p_positive")
    predictions = materialize(scored, "predictions")
    # MLlib's binned areas group the sorted scores per partition, so they can
    # move with the cluster layout; the exact areas sit next to them.
    exact = binary_areas(predictions, "p_positive", LABEL).first()
    test_counts = (exact["positives"] or 0, exact["negatives"] or 0)
    roc, pr = evaluator_areas(predictions, num_bins=num_bins, class_counts=test_counts)
    sample = sample_predictions(predictions, order_key, sample_size)

    profile_rows = profile.agg(
        F.array_sort(F.collect_list(F.struct(F.col(LABEL).cast("int").alias("label"), *profile.columns[1:])))
    ).scalar()
    confusion_rows = (
        confusion_matrix(predictions).agg(F.array_sort(F.collect_list(F.struct("label", "prediction", "count")))).scalar()
    )
    test_rows = predictions.agg(F.count(F.lit(1))).scalar()
    after = F.lit(totals["rows_after_cleaning"]).cast("long")
    summary = spark.range(1).select(
        F.lit(dataset_path).alias("dataset_path"),
        F.lit(totals["rows_before_cleaning"]).cast("long").alias("rows_before_cleaning"),
        after.alias("rows_after_cleaning"),
        (after - test_rows).alias("train_rows"),
        test_rows.alias("test_rows"),
        F.lit(float(sample_fraction)).alias("sample_fraction"),
        F.lit(int(max_iter)).alias("max_iter"),
        F.lit(float(decision_threshold)).alias("decision_threshold"),
        F.lit(round(roc, 4)).alias("area_under_roc"),
        F.lit(round(pr, 4)).alias("area_under_pr"),
        F.lit(_round4(exact["auc_roc"])).cast("double").alias("exact_area_under_roc"),
        F.lit(_round4(exact["auc_pr"])).cast("double").alias("exact_area_under_pr"),
        profile_rows.alias("sql_summary"),
        confusion_rows.alias("confusion_matrix"),
    )
    # Computed once: the document and the returned frame are the same row.
    summary = materialize(summary, "summary")
    if output_dir:
        out = output_dir.rstrip("/")
        write_sample_csv(sample, f"{out}/sample_predictions")
        write_document(summary, f"{out}/summary")
    discard(tally)
    return TrainingResult(model, features, summary, predictions.drop(order_key), roc, pr)
