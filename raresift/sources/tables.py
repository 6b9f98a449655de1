"""Batch table readers (SRC1, SRC2, SRC3, SRC8)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class InputNotFound(FileNotFoundError):
    """The input table does not exist (SRC2)."""


def reraise_missing(path: str, exc: AnalysisException) -> None:
    """Raise ``InputNotFound`` for a missing path, and any other error as it is."""
    if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
        raise InputNotFound(f"input table not found at {path}") from exc
    raise exc


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    infer_schema: bool = True,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Headed CSV table (SRC1).

    With ``schema`` (a ``StructType`` or a DDL string such as
    ``"Time double, Amount double, Class int"``) the read is a single pass
    and types are fixed.  Without it ``inferSchema`` costs one extra pass
    over the files; ``sampling_ratio`` makes that pass read only a fraction
    of the rows (large inputs).  A missing path raises
    :class:`InputNotFound` (SRC2) instead of a bare analysis error.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
        if infer_schema and sampling_ratio:
            reader = reader.option("samplingRatio", sampling_ratio)
    try:
        return reader.csv(path)
    except AnalysisException as exc:  # raised eagerly for a missing path
        reraise_missing(path, exc)
        raise


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV with every column kept as text (SRC3)."""
    return read_csv_table(spark, path, infer_schema=False)


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        reraise_missing(path, exc)
        raise


def read_report(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read back a nested JSON document written by the report sinks (SRC8)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.json(path)
    except AnalysisException as exc:
        reraise_missing(path, exc)
        raise
