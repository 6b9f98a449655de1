"""Distributed running sums over a global order.

A plain ``sum(...) OVER (ORDER BY x)`` moves every row into one task.  Here
the order key is first cut into ``B`` quantile buckets (one sketch pass,
``B`` numbers to the driver); each bucket is summed
on its own, a ``B``-row table of bucket offsets is built and broadcast
(its size is bounded by ``B``, not by the data), and the running sum inside
each bucket is an ordinary partitioned window.  Equal keys always fall in
the same bucket, so ties stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_rs_bucket"
# The offsets table is broadcast: one row (a bucket id and one number per
# summed column) per bucket.  This bound keeps it far below any broadcast
# limit (about 1M rows x a few doubles).
MAX_BUCKETS = 1_000_000
# Buckets unless told otherwise, and the accuracy of the sketch that cuts them:
# an edge is off by one in ACCURACY rows, so buckets stay within a factor of two.
DEFAULT_MOST = 4096
ACCURACY = 10_000
NULL_ORDER_KEY = "NULL_ORDER_KEY: a running total needs a value in the order column of every row"


def default_buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(DEFAULT_MOST, max(8, 2 * parts))


def quantile_splits(df: DataFrame, column: str, num_buckets: int) -> list[float]:
    """Strictly increasing bucket edges from approximate quantiles of ``column``.

    ``approx_percentile`` merges its sketches on the executors; their size
    follows ``ACCURACY``, not the number of buckets, and only the edges reach
    the driver.
    """
    probs = [i / num_buckets for i in range(1, num_buckets)]
    values = F.when(~F.isnan(column), F.col(column)) if dict(df.dtypes)[column] in ("double", "float") else F.col(column)
    edges = (df.agg(F.percentile_approx(values.cast("double"), probs, ACCURACY)).first()[0] or []) if probs else []
    inner = sorted({float(e) for e in edges if e is not None and abs(e) != float("inf") and e == e})
    return [float("-inf")] + inner + [float("inf")]


def running_totals(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    descending: bool = False,
    prefix: str = "cum_",
    num_buckets: int | None = None,
    quantile_source: DataFrame | None = None,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """Add ``prefix + c``: inclusive running sum of ``c`` in ``order_col`` order.

    ``order_col`` must be distinct per row (group first), or ``tie_breaker``
    columns must order its ties, which are then summed in one task.  A null
    in ``order_col`` is an error by name.  The buckets come from ``quantile_source`` (default ``df``): passing the raw rows before a
    ``groupBy`` saves recomputing the grouped table for the quantiles, and
    buckets balanced on raw rows are never larger in distinct keys.
    """
    num_buckets = num_buckets or default_buckets(df)
    if not 1 <= num_buckets <= MAX_BUCKETS:
        raise ValueError(f"num_buckets must be in [1, {MAX_BUCKETS}], got {num_buckets}")
    df = df.withColumn(
        order_col, F.coalesce(F.col(order_col), F.raise_error(F.lit(NULL_ORDER_KEY)).cast(df.schema[order_col].dataType))
    )
    splits = quantile_splits(quantile_source if quantile_source is not None else df, order_col, num_buckets)
    if len(splits) > 2:
        bucketed = Bucketizer(
            splits=splits, inputCol=order_col, outputCol=_BUCKET, handleInvalid="keep"
        ).transform(df)
    else:  # one bucket (tiny or constant input)
        bucketed = df.withColumn(_BUCKET, F.lit(0.0))

    totals = bucketed.groupBy(_BUCKET).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    bucket_order = F.col(_BUCKET).desc() if descending else F.col(_BUCKET).asc()
    before = Window.orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _BUCKET,
        *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
    )

    key_order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    inside = (
        Window.partitionBy(_BUCKET)
        .orderBy(key_order, *tie_breaker)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = bucketed.join(F.broadcast(offsets), _BUCKET)
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{c}") + F.sum(c).over(inside)).alias(f"{prefix}{c}") for c in sum_cols],
    )


def global_position(
    df: DataFrame,
    order_col: str,
    name: str = "position",
    num_buckets: int | None = None,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """0-based position of each row in ``order_col`` order (PRJ7, ordered variant).

    The distributed form of ``row_number() OVER (ORDER BY order_col) - 1``:
    a running count over quantile buckets, so no task ever sorts more than
    one bucket.  ``order_col`` must be numeric and not null; rows that share a
    value are in the order of the ``tie_breaker`` columns.
    """
    counted = df.withColumn("_one", F.lit(1))
    out = running_totals(counted, order_col, ["_one"], prefix="_cum", num_buckets=num_buckets, tie_breaker=tie_breaker)
    return out.withColumn(name, F.col("_cum_one") - 1).drop("_one", "_cum_one")
