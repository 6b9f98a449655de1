"""Weighted logistic regression by Newton steps on sums from one aggregate an iteration (ML3).

Every iteration is one pass: an aggregate sums the gradient and the upper half
of the Gram matrix of the rows, and the driver solves a system of (features +
1) unknowns.  Tasks compute the terms with numpy and sum them in fixed point,
as three longs each; such sums do not depend on the order of the rows, so the
fitted weights are the same on any layout and after any task retry, to the
last bit (as far as all machines compute ``exp`` alike).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresift.functions.expressions import DECISION_THRESHOLD
from raresift.functions.scoring import LinearScorer
from raresift.operators.persist import discard, materialize

#: A term is rounded to multiples of 2 ** -50 and summed as three longs, in these units.  The lower two are below
#: 2 ** 32 units, so 2 ** 31 rows fit; the upper one holds sums below 2 ** 77.
UNITS = (2.0**14, 2.0**-18, 2.0**-50)
#: The rows are written in row groups of so many bytes, so that a scan has a task for each core whatever the layout.
ROW_GROUP = 4 << 20
#: Steps shorter than this end the fit; so does this number of steps.
TOLERANCE = 1e-10
MOST_STEPS = 50

NOT_UNIQUE = "NO_UNIQUE_FIT: the features are linearly dependent, or a plane splits the classes; give a ridge above 0"


@dataclass(frozen=True)
class NewtonFit:
    """Weights on the raw features, and how the fit went."""

    scorer: LinearScorer
    steps: int
    loss: float


Terms = Callable[[dict[str, np.ndarray]], list[np.ndarray]]


def _longs(term: np.ndarray) -> list[int]:
    """Sums of a batch of terms in each of the units; powers of two, so only the last rounding isn't exact."""
    rest, sums = np.where(np.isfinite(term), term, 0.0), []
    if len(rest) and np.abs(rest).max() >= UNITS[0] * 2.0**62 / len(rest):
        raise OverflowError("SUM_OVERFLOW: terms too large for sums in fixed point")
    for unit in UNITS:
        whole = np.rint(rest / unit)
        rest = rest - whole * unit
        sums.append(int(whole.astype(np.int64).sum()))
    return sums


def _sums(rows: DataFrame, terms: Terms, n: int) -> list[float]:
    """Sums of the ``n`` terms of all rows in one pass, the same in any order of the rows; NaN and infinite terms count as 0.

    Each task adds up its rows by numpy, in longs, and Spark adds up the tasks' longs.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(all="ignore"):
                values = terms({c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names})
                longs = [v for term in values for v in _longs(term)]
            yield pa.record_batch([pa.array([v], pa.int64()) for v in longs], names=names)

    names = [f"s{i}" for i in range(n * len(UNITS))]
    row = rows.mapInArrow(parts, ", ".join(f"{c} long" for c in names)).agg(*[F.sum(c) for c in names]).first()
    sums = []
    for i in range(0, len(names), len(UNITS)):
        exact = sum(int(v or 0) * int(unit / UNITS[-1]) for v, unit in zip(row[i : i + len(UNITS)], UNITS))
        sums.append(exact / int(1 / UNITS[-1]))
    return sums


def _deviations(rows: DataFrame, names: Sequence[str]) -> list[float]:
    """Sample standard deviations from exact sums; 1 for a constant feature."""
    n, *sums = _sums(rows, lambda at: [np.ones(len(at["y"])), *[at[c] for c in names]], 1 + len(names))
    if n < 2:
        return [1.0] * len(names)
    means = dict(zip(names, [s / n for s in sums]))
    squares = _sums(rows, lambda at: [(at[c] - means[c]) ** 2 for c in names], len(names))
    return [float(np.sqrt(s / (n - 1))) or 1.0 for s in squares]


def newton_fit(
    train: DataFrame,
    feature_cols: Sequence[str],
    label: str = "label",
    weight: str | None = None,
    ridge: float = 0.0,
    threshold: float = DECISION_THRESHOLD,
) -> NewtonFit:
    """Minimise the weighted mean log loss plus ``ridge`` / 2 times the squared weights of the scaled features.

    Features are divided by their deviations, not centred; the intercept has
    no ridge.  Rows with a null or NaN in a used column are left out.  A step
    that would raise the loss is halved.  Data without a unique finite
    optimum raise an error by name.
    """
    names = [f"x{i}" for i in range(len(feature_cols))]
    one = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    columns = [F.col(c).cast("double").alias(x) for c, x in zip(feature_cols, names)]
    rows = train.select(*columns, F.col(label).cast("double").alias("y"), one.alias("w")).na.drop()
    rows = materialize(rows, "newton-rows", {"parquet.block.size": ROW_GROUP})
    try:
        scale = _deviations(rows, names)
        beta, steps, loss = _descend(rows, names, scale, ridge)
    finally:
        discard(rows)
    weights = {c: float(b / s) for c, b, s in zip(feature_cols, beta[1:], scale)}
    return NewtonFit(LinearScorer(intercept=float(beta[0]), weights=weights, threshold=threshold), steps, loss)


def _descend(rows: DataFrame, names: Sequence[str], scale: Sequence[float], ridge: float) -> tuple[np.ndarray, int, float]:
    k = 1 + len(names)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    penalty = np.diag([0.0] + [ridge] * (k - 1))

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def terms(at: dict[str, np.ndarray]) -> list[np.ndarray]:
            w, y = at["w"], at["y"]
            x = [np.ones(len(y)), *[at[c] / s for c, s in zip(names, scale)]]
            z = sum((b * c for b, c in zip(beta[1:], x[1:])), beta[0] * x[0])
            p = 1.0 / (1.0 + np.exp(-z))
            # log(1 + e^z) - y z, without overflow
            cost = np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z))) - y * z
            curve = w * p * (1.0 - p)
            return [w, w * cost, *[w * (p - y) * c for c in x], *[curve * x[i] * x[j] for i, j in upper]]

        row = _sums(rows, terms, 2 + k + len(upper))
        total = row[0]
        if not total > 0:
            raise ValueError("EMPTY_FIT: no rows with a positive weight")
        gradient = np.array(row[2 : 2 + k]) / total
        gram = np.zeros((k, k))
        for (i, j), v in zip(upper, row[2 + k :]):
            gram[i, j] = gram[j, i] = v / total
        return row[1] / total + float(beta @ penalty @ beta) / 2, gradient + penalty @ beta, gram + penalty

    beta = np.zeros(k)
    loss, gradient, gram = sums(beta)
    for step in range(1, MOST_STEPS + 1):
        if np.linalg.cond(gram) > 1e14:
            raise ValueError(NOT_UNIQUE)
        move = np.linalg.solve(gram, gradient)
        while True:
            there = sums(beta - move)
            if there[0] <= loss + 1e-12 or np.abs(move).max() < TOLERANCE:
                break
            move = move / 2
        beta = beta - move
        loss, gradient, gram = there
        if np.abs(move).max() < TOLERANCE:
            return beta, step, loss
    raise ValueError(NOT_UNIQUE)
