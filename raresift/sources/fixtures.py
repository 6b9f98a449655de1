"""Test fixtures derived from the shared parquet tables.

``transactions`` turns ``lineitem`` into a card-transaction-shaped table
(key, numeric features, 0/1 ``Class``); ``event_features`` turns ``events``
into the message payload of the stream.  Both are plain projections of the
scanned tables, so filters and column pruning reach the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Feature layout of the two fixtures.
TXN_FEATURES = ["Time", "V1", "V2", "V3", "Amount"]
EVENT_FEATURES = ["Time", "V1", "V2", "Amount"]
TXN_KEY = "txn_key"
EVENT_KEY = "__id"
# Epoch of the ``Time`` column and the duplicate slice.
TIME_EPOCH = "1995-01-01"
DUPLICATED_QUANTITY = 7.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """Fixture T: one row per line item.

    ``Class`` is 1 for a line with quantity >= 50 and discount >= 0.1.
    With ``faults`` the raw table carries what cleaning must remove:
    ``V3`` is null where the tax is 0, and every line with quantity 7 is
    delivered twice (``UNION ALL``).
    """
    li = table(spark, sf_dir, "lineitem")
    tax = F.nullif(F.col("l_tax"), F.lit(0.0)) if faults else F.col("l_tax")
    base = li.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias(TXN_KEY),
        F.datediff(F.to_date("l_shipdate"), F.lit(TIME_EPOCH).cast("date")).cast("double").alias("Time"),
        F.col("l_quantity").alias("V1"),
        F.col("l_discount").alias("V2"),
        tax.alias("V3"),
        F.col("l_extendedprice").alias("Amount"),
        F.when((F.col("l_quantity") >= 50) & (F.col("l_discount") >= 0.1), 1).otherwise(0).alias("Class"),
    )
    if not faults:
        return base
    return base.unionByName(base.filter(F.col("V1") == F.lit(DUPLICATED_QUANTITY)))


CARD_KEY = "row_id"


def card_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture C: all line items in the 30-column card layout (``Time, V1..V28, Amount``).

    ``V1..V28`` are the digits after the point of multiples of the discount, tax
    and quantity, so every column differs and any SQL engine derives the same.
    """
    li = table(spark, sf_dir, "lineitem")
    base = F.col("l_quantity") * 7 + F.col("l_discount") * 100 + F.col("l_tax") * 300
    v = [((base * i) % 10).alias(f"V{i}") for i in range(1, 29)]
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias(CARD_KEY),
        F.datediff(F.to_date("l_shipdate"), F.lit(TIME_EPOCH).cast("date")).cast("double").alias("Time"),
        *v,
        F.col("l_extendedprice").alias("Amount"),
    )


def _epoch_micros(col: str):
    """Microseconds since 1970-01-01 of a zone-less timestamp, whatever the session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})")


def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E: ``__id``, the four numeric features and the 0/1 ``label``.

    ``Time`` is epoch seconds of ``ts`` (zone-less, so read as UTC), ``V1`` the user,
    ``V2`` the ``k`` entry of the JSON ``props`` and ``Amount`` the value;
    ``label`` marks error events.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias(EVENT_KEY),
        (_epoch_micros("ts") / F.lit(1e6)).alias("Time"),
        F.col("user_id").cast("double").alias("V1"),
        F.get_json_object("props", "$.k").try_cast("double").alias("V2"),
        F.col("value").alias("Amount"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )


# Ids of the faults injected into the event-message fixture.
# Each replaces the message of that id; all ids exist at every scale.
MISSING_FIELD_ID = 13  # "Amount" left out
JSON_NULL_ID = 17  # "V1": null
NAN_ID = 19  # "Time": "nan"
NOT_A_NUMBER_ID = 23  # "V2": "abc"
NOT_JSON_ID = 29  # text that is not JSON
JSON_ARRAY_ID = 31  # a JSON array instead of an object
NULL_MESSAGE_ID = 37  # the JSON literal null
REDELIVERED_IDS = (5, 50, 500)  # delivered a second time, in a later file
# So are high amounts of even ids: rows that the constant scorer flags.
REDELIVERED_AMOUNT = 200.0
# Message times are cut to the day, so that flagged rows share a ``Time``.
MESSAGE_TIME_STEP = 86400
INVALID_IDS = (MISSING_FIELD_ID, JSON_NULL_ID, NAN_ID, NOT_A_NUMBER_ID)
BAD_IDS = (NOT_JSON_ID, JSON_ARRAY_ID, NULL_MESSAGE_ID)


def event_messages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The published message stream of fixture E, as three deliveries.

    ``first``: the sentinel alone (it must not end the run early);
    ``body``: one message per event with the faults above;
    ``redelivered``: exact repeats of a few body messages, flagged ones among them.
    ``Time`` is cut to the day, so several rows share one.
    Each is a DataFrame of ``__id`` (null for the sentinel) and ``value``.
    """
    from raresift.operators.events import encode_messages, sentinel_message

    step = F.lit(float(MESSAGE_TIME_STEP))
    feats = event_features(spark, sf_dir).withColumn("Time", F.floor(F.col("Time") / step) * step)
    repeat = F.col(EVENT_KEY).isin(*REDELIVERED_IDS) | ((F.col("Amount") >= REDELIVERED_AMOUNT) & (F.col(EVENT_KEY) % 2 == 0))
    clean = encode_messages(feats, EVENT_KEY, EVENT_FEATURES + ["label"])
    i = F.col(EVENT_KEY)
    v = F.col("value")
    faulty = (
        F.when(i == MISSING_FIELD_ID, F.regexp_replace(v, r',?"Amount":"[^"]*"', ""))
        .when(i == JSON_NULL_ID, F.regexp_replace(v, r'"V1":"[^"]*"', '"V1":null'))
        .when(i == NAN_ID, F.regexp_replace(v, r'"Time":"[^"]*"', '"Time":"nan"'))
        .when(i == NOT_A_NUMBER_ID, F.regexp_replace(v, r'"V2":"[^"]*"', '"V2":"abc"'))
        .when(i == NOT_JSON_ID, F.concat(F.lit("not json {"), i.cast("string")))
        .when(i == JSON_ARRAY_ID, F.concat(F.lit("["), i.cast("string"), F.lit(", 2, 3]")))
        .when(i == NULL_MESSAGE_ID, F.lit("null"))
        .otherwise(v)
    )
    body = clean.select(i, faulty.alias("value"))
    repeated = feats.filter(repeat & ~i.isin(*INVALID_IDS, *BAD_IDS))
    return {
        "first": sentinel_message(clean),
        "body": body,
        "redelivered": encode_messages(repeated, EVENT_KEY, EVENT_FEATURES + ["label"]),
    }
