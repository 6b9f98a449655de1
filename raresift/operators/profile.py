"""Counts, class weights and the per-class SQL profile (AGG1-4, PRJ2, FLT1, SQL1-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raresift.functions.schema import LABEL, WEIGHT

NO_POSITIVES = "NO_POSITIVE_ROWS: the class weight needs at least one row with label 1"

# Names and rounding of the class profile's columns.
PROFILE_COUNT = "transaction_count"
PROFILE_MEASURES = (("avg_amount", "avg", "Amount"), ("max_amount", "max", "Amount"))
PROFILE_DIGITS = 2


def positive_weight(df: DataFrame, label: str = LABEL) -> Column:
    """``sqrt(negatives / positives)`` as a scalar-subquery column (AGG3).

    Spark runs the one-row count as a subquery and inlines the value, so the
    weight never makes a driver round trip and no join is needed.  A table
    without positives fails with a named error instead of dividing by zero.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 1).alias("p"),
    )
    ratio = F.sqrt((F.col("n") - F.col("p")).cast("double") / F.col("p"))
    weight = counts.select(
        F.when(F.col("p") == 0, F.raise_error(F.lit(NO_POSITIVES))).otherwise(ratio).alias("w")
    )
    return weight.scalar()


def with_class_weight(
    df: DataFrame, label: str = LABEL, weight: str = WEIGHT, counts: tuple[int, int] | None = None
) -> DataFrame:
    """Append ``weight``: the positive weight for label 1, 1.0 otherwise (PRJ2).

    ``counts`` (rows, positives), when the caller has them, saves the
    counting pass over ``df``.
    """
    if counts is None:
        value = positive_weight(df, label)
    else:
        rows, positives = counts
        if not positives:
            raise ValueError(NO_POSITIVES)
        value = F.lit(((rows - positives) / positives) ** 0.5)
    return df.withColumn(weight, F.when(F.col(label) == 1, value).otherwise(F.lit(1.0)))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Per-class rows and weight, weight rounded to 6 places.

    The per-class counts hold all that the weight needs, so ``df`` is read
    once; the sums over them run over one row per class.
    """
    by_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    every = Window.partitionBy()
    n = F.sum("rows").over(every)
    p = F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("rows"))).over(every), F.lit(0))
    weight = F.when(F.col(label) == 1, F.sqrt((n - p).cast("double") / p)).otherwise(F.lit(1.0))
    checked = F.when(p == 0, F.raise_error(F.lit(NO_POSITIVES)).cast("double")).otherwise(F.round(weight, 6))
    return by_class.select(label, "rows", checked.alias("weight"))


def profile_sql(
    view: str,
    group: str = LABEL,
    count: str = PROFILE_COUNT,
    measures: Sequence[tuple[str, str, str]] = PROFILE_MEASURES,
    digits: int = PROFILE_DIGITS,
) -> str:
    """A grouped profile as SQL: row count and rounded ``(name, function, column)`` measures, by group."""
    values = [f"round({function}(`{column}`), {digits}) AS `{name}`" for name, function, column in measures]
    columns = ", ".join([f"`{group}`", f"count(*) AS `{count}`", *values])
    return f"SELECT {columns} FROM `{view}` GROUP BY `{group}` ORDER BY `{group}`"


def class_profile(spark: SparkSession, df: DataFrame, view: str = "transactions", keep_view: bool = False, **parts) -> DataFrame:
    """Register ``df`` as a temp view and run the profile SQL (SQL1, SQL2, AGG4, ORD1).

    Only the group and measure columns are read; Catalyst prunes every other
    column down to the scan, and the aggregate is partial + final.  The view
    is dropped once the statement is resolved, unless ``keep_view``.
    """
    df.createOrReplaceTempView(view)
    try:
        return spark.sql(profile_sql(view, **parts))
    finally:
        if not keep_view:
            spark.catalog.dropTempView(view)
