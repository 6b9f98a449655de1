"""Closed-form logistic scorer (ML5, ML7 as a codegen expression).

A fitted assembler -> unit-variance scaler -> logistic regression chain is
``sigmoid(b + sum_i coef_i * x_i / std_i)``.  Folding ``1/std_i`` into the
weights gives a plain column expression: it runs inside whole-stage codegen,
needs no vector columns, works the same on batch and streaming frames and
can be written in any SQL dialect (the oracle uses that).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresift.functions.expressions import DECISION_THRESHOLD


@dataclass(frozen=True)
class LinearScorer:
    intercept: float
    weights: Mapping[str, float] = field(default_factory=dict)
    threshold: float = DECISION_THRESHOLD

    def margin(self) -> Column:
        z = F.lit(float(self.intercept))
        for name, w in self.weights.items():
            if w != 0.0:
                z = z + F.lit(float(w)) * F.col(name)
        return z

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))

    def prediction(self, probability: Column | None = None) -> Column:
        p = probability if probability is not None else self.probability()
        return F.when(p > F.lit(float(self.threshold)), F.lit(1.0)).otherwise(F.lit(0.0))

    def score(self, df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        """Append the positive-class probability and the 0.0/1.0 decision."""
        scored = df.withColumn(probability, self.probability())
        return scored.withColumn(prediction, self.prediction(F.col(probability)))

    def sql_probability(self, quote: str = '"') -> str:
        """The same probability as SQL text (for the oracle)."""
        z = repr(float(self.intercept))
        for name, w in self.weights.items():
            if w != 0.0:
                z = f"{z} + {float(w)!r} * {quote}{name}{quote}"
        return f"1.0 / (1.0 + exp(-({z})))"

    @classmethod
    def from_pipeline_model(cls, model, feature_cols: list[str]) -> "LinearScorer":
        """Read coefficients out of a fitted assembler/scaler/LR pipeline.

        Only ``len(feature_cols)`` numbers travel to the driver.  A feature
        with zero deviation gets weight 0, as the scaler outputs 0 for it.
        """
        from pyspark.ml.classification import LogisticRegressionModel
        from pyspark.ml.feature import StandardScalerModel

        scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
        lr = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
        std = scaler.std.toArray()
        coef = lr.coefficients.toArray()
        with_std = scaler.getWithStd()
        weights = {}
        for name, c, s in zip(feature_cols, coef, std):
            if not with_std:
                weights[name] = float(c)
            else:
                weights[name] = float(c / s) if s != 0.0 else 0.0
        return cls(intercept=float(lr.intercept), weights=weights, threshold=float(lr.getThreshold()))
