"""Labelled rows for the two classifiers: folds, and a bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
#: Most labelled rows a model is fitted on; their ids are broadcast (8 bytes each).
MAX_TRAINING = 40_000


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text is divisible by the number of folds; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int = MAX_TRAINING, id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, text, y) of labelled documents outside the held-out fold.

    Where there are more than ``max_rows``, those with the smallest hash of
    the id.  The largest label of an id counts; null ids and labels are left
    out.  The join sends the bounded list of ids to the tasks, so texts don't
    move.
    """
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.max(label_col).cast("int").alias("y"))
        .filter(~held_out("doc_id"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "y")
