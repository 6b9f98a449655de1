"""Reproducible train/test split (SMP2).

``randomSplit`` draws per partition, so the same seed on a different layout
moves rows between the sides.  The split here is a hash of a unique key:
the same rows land in the same side on any cluster, after any retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresift.functions.expressions import SEED, TRAIN_FRACTION, hash_fraction

SPLIT = "split"


def split_flag(key: str | Column, train_fraction: float = TRAIN_FRACTION, seed: int = SEED) -> Column:
    """'train' for about ``train_fraction`` of keys, 'test' for the rest and for a null key."""
    return F.when(hash_fraction(key, train_fraction, seed), F.lit("train")).otherwise(F.lit("test"))


def with_split(
    df: DataFrame, key: str | Column, train_fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> DataFrame:
    return df.withColumn(SPLIT, split_flag(key, train_fraction, seed))


def train_test_split(
    df: DataFrame, key: str | Column, train_fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Two filters over the same input, by :func:`split_flag`; every row is on one side."""
    side = split_flag(key, train_fraction, seed)
    return df.filter(side == "train"), df.filter(side == "test")


def split_counts(df: DataFrame, key: str | Column, label: str, **kw) -> DataFrame:
    """Rows per (split, label) in one pass over the input."""
    return (
        with_split(df, key, **kw)
        .groupBy(SPLIT, F.col(label).cast("int").alias(label))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
