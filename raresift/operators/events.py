"""Event messages: encode rows as JSON, decode and route them (PRJ7, SNK5, SRC5, FLT4-6, FN4-6, FN8).

A message is one JSON object in a ``value`` string column — the shape of a
text file line, a Kafka record value or a message-bus payload.  Data
messages carry every feature as text plus the publisher's ``__id``; the
end-of-stream control message is ``{"__sentinel": "DONE", "total_published": n}``.

Decoding never fails a batch: every message gets a ``kind``

* ``bad``      – not a JSON object (broken text, array, ``null``, scalar);
* ``sentinel`` – the control message;
* ``invalid``  – an object with a feature missing, not a number, or NaN;
* ``ok``       – ready to score,

and ``reason`` says what was wrong, so rejects go to a quarantine output
instead of being dropped or retried forever.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from raresift.functions.expressions import parse_double
from raresift.functions.schema import feature_schema

# Field names of the message format and the end-of-stream marker.
ID = "__id"
SENTINEL_FIELD = "__sentinel"
TOTAL_FIELD = "total_published"
SENTINEL_VALUE = "DONE"

CORRUPT = "_corrupt"
KINDS = ("ok", "invalid", "bad", "sentinel")


# --------------------------------------------------------------------------
# Encoding
# --------------------------------------------------------------------------

def with_input_position(df: DataFrame, name: str = ID) -> DataFrame:
    """0-based position of each row in its input files (PRJ7) without a global sort.

    Rows are ordered by (file path, byte offset of the split, position in
    the split).  Only one small table is built — one row per input split,
    with the running row offset of the split — and joined back on a compact
    (path hash, split offset) key.  The data itself is never sorted.  The
    join is left to adaptive execution: the offsets table is broadcast when
    its measured size is under the broadcast threshold (the usual case: a few
    dozen bytes per split), otherwise both sides are shuffled by split,
    which keeps tasks balanced.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_pos_path"),
        F.col("_metadata.file_block_start").alias("_pos_block"),
        F.monotonically_increasing_id().alias("_pos_mono"),
    ).withColumn("_pos_file", F.xxhash64("_pos_path"))
    splits = tagged.groupBy("_pos_file", "_pos_path", "_pos_block").agg(
        F.count(F.lit(1)).alias("_pos_rows"), F.min("_pos_mono").alias("_pos_first")
    )
    before = Window.orderBy("_pos_path", "_pos_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "_pos_file",
        "_pos_block",
        "_pos_first",
        F.coalesce(F.sum("_pos_rows").over(before), F.lit(0)).alias("_pos_offset"),
    )
    return tagged.join(offsets, ["_pos_file", "_pos_block"]).select(
        *df.columns,
        (F.col("_pos_offset") + F.col("_pos_mono") - F.col("_pos_first")).alias(name),
    )


def encode_messages(df: DataFrame, id_col: str = ID, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column as text plus the integer ``__id`` as one JSON object (SNK5, FN6).

    Values are strings, as a CSV reader hands them over; the id stays a
    number.  Output: ``__id`` (long) and ``value`` (the JSON text).
    """
    cols = [c for c in (columns or df.columns) if c != id_col]
    payload = F.struct(*[F.col(c).cast("string").alias(c) for c in cols], F.col(id_col).cast("long").alias(ID))
    return df.select(F.col(id_col).cast("long").alias(ID), F.to_json(payload).alias("value"))


def sentinel_message(data_messages: DataFrame) -> DataFrame:
    """The control message, with the number of data messages it closes."""
    return data_messages.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("long").alias(ID),
        F.to_json(
            F.struct(F.lit(SENTINEL_VALUE).alias(SENTINEL_FIELD), F.col("n").alias(TOTAL_FIELD))
        ).alias("value"),
    )


# --------------------------------------------------------------------------
# Decoding
# --------------------------------------------------------------------------

def message_schema(feature_cols: Sequence[str], passthrough: Sequence[str] = ()) -> StructType:
    """Every known field as text; non-string JSON values arrive as their JSON text."""
    names = list(feature_cols) + list(passthrough) + [ID, SENTINEL_FIELD, TOTAL_FIELD]
    return StructType([StructField(n, StringType(), True) for n in names] + [StructField(CORRUPT, StringType(), True)])


def _problems(feature_cols: Sequence[str]) -> Column:
    """Names of the fields that are missing, not numbers or NaN (FLT4), from the texts ``_m`` and the numbers ``_f``."""
    checks = [
        F.when(F.col(f"_m.{c}").isNull(), F.lit(f"{c}:missing"))
        .when(F.col(f"_f.{c}").isNull(), F.lit(f"{c}:not_a_number"))
        .when(F.isnan(F.col(f"_f.{c}")), F.lit(f"{c}:nan"))
        for c in feature_cols
    ]
    return F.concat_ws(",", *checks)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once per row, however often later columns and filters use it.

    A column of a projection is copied into whatever reads it, a pushed
    filter included; the one entry of a generated array isn't.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def decode_messages(
    messages: DataFrame,
    feature_cols: Sequence[str],
    passthrough: Sequence[str] = (),
    value_col: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse and route every message (SRC5, FLT4, FLT5, FLT6, FN4, FN5, FN8).

    Output columns: ``keep`` (e.g. arrival metadata), ``__id``, ``kind``,
    ``reason``, the features typed by :func:`feature_schema` (nullable
    doubles), ``passthrough`` fields as text, ``total_published`` (sentinel
    only) and the original ``value``.  Works unchanged on a streaming
    DataFrame.
    """
    typed = feature_schema(feature_cols)
    schema = message_schema(feature_cols, passthrough)
    texts = messages.select(*keep, F.col(value_col).cast("string").alias("value"))
    parsed = once(texts, "_m", F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT}))
    numbers = [parse_double(F.col(f"_m.{f.name}")).cast(f.dataType).alias(f.name) for f in typed.fields]
    # The test that every row needs is short; the names of the problems are put together for the rows that have some.
    # With them in the kind, the generated code of many features outgrows what the JVM compiles.
    complete = reduce(and_, [F.col(f"_f.{c}").isNotNull() & ~F.isnan(F.col(f"_f.{c}")) for c in feature_cols], F.lit(True))
    parsed = once(once(parsed, "_f", F.struct(*numbers)), "_ok", complete)
    is_object = F.col("_m").isNotNull() & F.col(f"_m.{CORRUPT}").isNull()
    is_sentinel = is_object & (F.col(f"_m.{SENTINEL_FIELD}") == F.lit(SENTINEL_VALUE))
    kind = (
        F.when(~is_object | F.col("_m").isNull(), F.lit("bad"))
        .when(is_sentinel, F.lit("sentinel"))
        .when(~F.col("_ok"), F.lit("invalid"))
        .otherwise(F.lit("ok"))
    )
    reason = (
        F.when(~is_object | F.col("_m").isNull(), F.lit("not_a_json_object"))
        .when(is_sentinel, F.lit(None).cast("string"))
        .when(~F.col("_ok"), _problems(feature_cols))
    )
    return parsed.select(
        *keep,
        F.col(f"_m.{ID}").try_cast("long").alias(ID),
        kind.alias("kind"),
        reason.alias("reason"),
        *[F.col(f"_f.{f.name}").alias(f.name) for f in typed.fields],
        *[F.col(f"_m.{c}").alias(c) for c in passthrough],
        F.when(is_sentinel, F.coalesce(F.col(f"_m.{TOTAL_FIELD}").try_cast("long"), F.lit(0)))
        .cast("long")
        .alias(TOTAL_FIELD),
        "value",
    )
