"""Malformed CSV rows, set aside with a reason (SRC1, SRC3).

A reader with a fixed schema turns what it can't parse into nulls, and
cleaning drops the row unseen.  Here the parser hands over the text of each
row that doesn't fit, and that text is looked at again, field by field, to say
what was wrong with it.  Only malformed rows are looked at twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from raresift.sources.tables import reraise_missing

LINE = "line"
REASON = "reason"


def _reasons(texts: Column, schema: StructType, line: Column) -> Column:
    """``field:not_a_type`` for each field that can't be parsed; else what is wrong with their number."""
    fields = [
        F.when(texts[f.name].isNotNull() & texts[f.name].try_cast(f.dataType).isNull(), F.lit(f"{f.name}:not_a_{f.dataType.simpleString()}"))
        for f in schema.fields
    ]
    wrong = F.concat_ws(",", *fields)
    # with a column more for the rest of the line, the parser itself counts the fields
    last = texts[schema.fields[-1].name]
    number = F.when(texts["_more"].isNotNull(), F.lit("too_many_fields")).when(last.isNull(), F.lit("too_few_fields")).otherwise(F.lit("malformed"))
    return F.when(wrong != "", wrong).otherwise(number)


def read_csv_quarantined(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``schema``, malformed rows with their fields as text, ``line`` and ``reason``).

    An empty field is a null and fits.  Every column is parsed, whatever a
    caller selects, so the same rows are malformed for every caller.  A missing
    path raises ``InputNotFound``.
    """
    names = schema.fieldNames()
    taken = "_line"
    while taken in names:
        taken += "_"
    whole = StructType([*schema.fields, StructField(taken, StringType())])
    reader = spark.read.schema(whole).option("header", header).option("mode", "PERMISSIVE")
    # a pruned column would not be parsed, and its faults not be seen
    reader = reader.option("columnNameOfCorruptRecord", taken).option("columnPruning", False).option("enforceSchema", True)
    try:
        rows = reader.csv(path)
    except AnalysisException as exc:
        reraise_missing(path, exc)
        raise
    strings = ", ".join([*(f"`{n}` string" for n in names), "_more string"])
    # Spark refuses to read a malformed row's text alone: the condition reads all columns, whatever the caller keeps
    rows = rows.filter(F.size(F.array_compact(F.array(*[F.col(f"`{n}`").cast("string") for n in names]))) >= 0)
    good = rows.filter(F.col(taken).isNull()).select(*[f"`{n}`" for n in names])
    bad = rows.filter(F.col(taken).isNotNull()).select(F.col(taken).alias(LINE), F.from_csv(taken, strings, {"mode": "PERMISSIVE"}).alias("_t"))
    bad = bad.select(*[F.col(f"_t.{n}").alias(n) for n in names], LINE, _reasons(F.col("_t"), schema, F.col(LINE)).alias(REASON))
    return good, bad
