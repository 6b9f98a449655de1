"""Fit, score, save and load the classifier (ML1-ML7, SNK1, SRC7).

The model is MLlib's assembler -> unit-variance scaler (no centring) ->
weighted logistic regression.  Fitting is MLlib's distributed optimiser
(one tree aggregate per iteration); scoring is ``PipelineModel.transform``,
which works unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.functions.expressions import DECISION_THRESHOLD, MAX_ITER
from raresift.functions.schema import LABEL, WEIGHT

RAW_FEATURES = "raw_features"
FEATURES = "features"


def build_classifier(
    feature_cols: Sequence[str],
    label: str = LABEL,
    weight: str | None = WEIGHT,
    max_iter: int = MAX_ITER,
    threshold: float = DECISION_THRESHOLD,
) -> Pipeline:
    """The three-stage pipeline (ML1 assembler, ML2 scaler, ML3 regression)."""
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol=RAW_FEATURES)
    scaler = StandardScaler(inputCol=RAW_FEATURES, outputCol=FEATURES, withMean=False, withStd=True)
    lr_args = dict(featuresCol=FEATURES, labelCol=label, maxIter=max_iter, threshold=threshold)
    if weight:
        lr_args["weightCol"] = weight
    return Pipeline(stages=[assembler, scaler, LogisticRegression(**lr_args)])


def fit_scaler(train: DataFrame, feature_cols: Sequence[str]) -> PipelineModel:
    """Assembler + unit-variance scaler only (ML1, ML2): one summary pass."""
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol=RAW_FEATURES)
    scaler = StandardScaler(inputCol=RAW_FEATURES, outputCol=FEATURES, withMean=False, withStd=True)
    return Pipeline(stages=[assembler, scaler]).fit(train)


def fit_classifier(train: DataFrame, feature_cols: Sequence[str], **kw) -> PipelineModel:
    """Fit on the training rows (ML4)."""
    return build_classifier(feature_cols, **kw).fit(train)


def score(model: PipelineModel, df: DataFrame, probability: str = "p_positive") -> DataFrame:
    """Score rows (ML5/ML6); adds the positive-class probability as a double.

    ``prediction`` is 1.0 exactly when that probability exceeds the fitted
    threshold (ML7).
    """
    return model.transform(df).withColumn(probability, vector_to_array(F.col("probability"))[1])


def save_model(model: PipelineModel, path: str) -> str:
    """Save, replacing what is there (SNK1)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline (SRC7)."""
    return PipelineModel.load(path)


def scaler_deviations(model: PipelineModel, feature_cols: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, standard deviation) pairs of the fitted scaler — one per feature."""
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    return list(zip(feature_cols, (float(x) for x in scaler.std.toArray())))
