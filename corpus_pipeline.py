"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage works on all rows that the one before kept, and its decisions
take effect: toxic documents, near duplicates and documents with benchmark
passages go, repeated passages are cut from the texts, and what is left is
packed into token sequences.  All but the last return the columns of their
input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raresift.llm._tokens import default_tokenizer
from raresift.llm.decontaminate import remove_contaminated
from raresift.llm.near_duplicates import remove_near_duplicates
from raresift.llm.packing import pack
from raresift.llm.suffix_dedup import rewrite_without_repeats
from raresift.llm.toxicity import fit_toxicity, remove_toxic
from raresift.operators.persist import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a model of the labelled ones finds toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return remove_toxic(docs, fit_toxicity(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 80 percent of equal 5-word shingles."""
    return remove_near_duplicates(docs, shingle=5, percent=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start in an earlier document."""
    return rewrite_without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024 ids."""
    return pack(docs, default_tokenizer())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The stages fit a model and pack at random, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
