"""Cleaning: sample, drop incomplete rows, de-duplicate, rename (SMP1, FLT3, DUP1, PRJ1).

Order matters and follows the training job: sample -> count -> drop rows
with a null/NaN -> drop exact duplicates over every column (label
included) -> rename the target to ``label``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresift.functions.expressions import SEED, hash_fraction, hash_key
from raresift.functions.schema import LABEL, TARGET


def sample_rows(
    df: DataFrame,
    fraction: float,
    seed: int = SEED,
    key: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Bernoulli sample without replacement, only when ``fraction < 1`` (SMP1).

    With ``key`` the draw is a hash of the key (reproducible on any cluster
    layout, and copies of a row share their fate).  Without a key it is
    Spark's seeded ``sample``, which depends on the partitioning.
    """
    if fraction >= 1.0:
        return df
    if key:
        return df.filter(hash_fraction(hash_key(key), fraction, seed))
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows holding a null in any column; NaN counts as null (FLT3)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (DUP1).

    Planned as a hash aggregate with a map-side partial step, so a row
    copied a million times shrinks to one row per map task before the
    shuffle: a hot group of copies never lands whole on one reducer.
    """
    return df.dropDuplicates()


def clean_table(df: DataFrame, target: str = TARGET, label: str = LABEL) -> DataFrame:
    """Drop incomplete rows, then duplicates, then rename the target (PRJ1)."""
    return drop_duplicate_rows(drop_incomplete(df)).withColumnRenamed(target, label)


COPIES = "_copies"


def is_complete(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """True for rows that :func:`drop_incomplete` keeps (no null; no NaN in float columns)."""
    types = dict(df.dtypes)
    checks = []
    for c in cols or df.columns:
        ok = F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        checks.append(ok)
    out = checks[0]
    for ok in checks[1:]:
        out = out & ok
    return out


def tally_rows(df: DataFrame) -> DataFrame:
    """Distinct complete rows with their number of copies, and one all-null row for all incomplete ones.

    The same map-side-combined aggregate as :func:`drop_duplicate_rows`,
    plus a count: the sum of ``_copies`` is the input row count, so a job
    that needs "rows before cleaning" gets it without a second input scan.
    Incomplete rows shrink to one row a task before the shuffle.
    """
    complete = is_complete(df)
    return df.groupBy(*[F.when(complete, F.col(c)).alias(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES))


def tally_counts(tally: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows before cleaning, after cleaning, and per class, in one aggregate over a tally."""
    return tally.agg(
        F.sum(COPIES).alias("rows_before_cleaning"),
        F.count_if(F.col(target).isNotNull()).alias("rows_after_cleaning"),
        F.count_if(F.col(target) == 1).alias("positives"),
        F.count_if(F.col(target) != 1).alias("negatives"),
    )


def clean_tally(tally: DataFrame, target: str = TARGET, label: str = LABEL) -> DataFrame:
    """The cleaned table from a tally: its complete rows, renamed.

    Equal to :func:`clean_table` on the tallied input.  Only the target is
    looked at to tell the incomplete row, so other columns stay prunable.
    """
    cols = [c for c in tally.columns if c != COPIES]
    return tally.filter(F.col(target).isNotNull()).select(*cols).withColumnRenamed(target, label)
