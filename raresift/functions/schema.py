"""Schemas and feature-list helpers (SRC6, PRJ4)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

LABEL = "label"
WEIGHT = "weight"
TARGET = "Class"


def feature_schema(names: Sequence[str]) -> StructType:
    """All-double, nullable schema in the given order.

    The scoring schema of the original data set is ``Time, V1..V28, Amount``;
    ``card_feature_names()`` returns exactly that list.  The feature list is a
    parameter everywhere, so smaller fixtures use fewer columns.
    """
    return StructType([StructField(n, DoubleType(), True) for n in names])


def card_feature_names(n_components: int = 28) -> list[str]:
    """``Time, V1..Vn, Amount`` — the layout of the card-transaction table."""
    return ["Time"] + [f"V{i}" for i in range(1, n_components + 1)] + ["Amount"]


def feature_columns(
    df: DataFrame,
    exclude: Iterable[str] = (LABEL, WEIGHT),
    extra_exclude: Iterable[str] = (),
) -> list[str]:
    """All columns except the excluded ones, in table order (PRJ4)."""
    drop = set(exclude) | set(extra_exclude)
    return [c for c in df.columns if c not in drop]
