import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from raresift.operators.events import decode_messages, encode_messages, sentinel_message, with_input_position
from raresift.session import scratch_path
from raresift.sources import fixtures as fx
from raresift.sources.tables import InputNotFound, read_csv_strings, read_csv_table


def test_encode_decode_round_trip_loses_nothing(spark):
    ev = fx.event_features(spark, SF_SMALL)
    back = decode_messages(encode_messages(ev, fx.EVENT_KEY, fx.EVENT_FEATURES), fx.EVENT_FEATURES)
    assert back.filter(F.col("kind") != "ok").count() == 0
    joined = ev.alias("a").join(back.alias("b"), fx.EVENT_KEY)
    diff = joined.filter(" OR ".join(f"a.{c} <> b.{c}" for c in fx.EVENT_FEATURES)).count()
    assert joined.count() == ev.count() and diff == 0


def test_values_travel_as_strings(spark):
    ev = fx.event_features(spark, SF_SMALL).limit(1)
    text = encode_messages(ev, fx.EVENT_KEY, fx.EVENT_FEATURES).first()["value"]
    assert '"Time":"' in text and '"__id":' in text and '"__id":"' not in text


def test_fault_kinds(spark):
    m = fx.event_messages(spark, SF_SMALL)
    decoded = decode_messages(m["first"].unionByName(m["body"]), fx.EVENT_FEATURES)
    kinds = {r["kind"]: r["n"] for r in decoded.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"sentinel": 1, "bad": 3, "invalid": 4, "ok": 1000 - 7}
    reasons = {r[fx.EVENT_KEY]: r["reason"] for r in decoded.filter(F.col("kind") == "invalid").collect()}
    assert reasons == {13: "Amount:missing", 17: "V1:missing", 19: "Time:nan", 23: "V2:not_a_number"}
    total = decoded.filter(F.col("kind") == "sentinel").first()["total_published"]
    assert total == 1000


def test_sentinel_total_defaults_to_zero(spark):
    df = spark.createDataFrame([('{"__sentinel": "DONE"}',)], "value string")
    row = decode_messages(df, ["Time"]).first()
    assert row["kind"] == "sentinel" and row["total_published"] == 0


def test_number_parsing(spark):
    vals = [" 1.5 ", "1e+05", "inf", "abc", "1_0"]
    df = spark.createDataFrame([(f'{{"Time": "{v}", "__id": {i}}}',) for i, v in enumerate(vals)], "value string")
    got = {r["__id"]: (r["kind"], r["Time"]) for r in decode_messages(df, ["Time"]).collect()}
    assert got[0] == ("ok", 1.5) and got[1] == ("ok", 100000.0) and got[2] == ("ok", float("inf"))
    assert got[3][0] == "invalid" and got[4][0] == "invalid"


def test_csv_sources_and_input_position(spark):
    ev = fx.event_features(spark, SF_SMALL)
    path = scratch_path(spark, "csv")
    ev.orderBy(fx.EVENT_KEY).repartitionByRange(3, fx.EVENT_KEY).write.option("header", True).csv(path)
    typed = read_csv_table(spark, path)
    assert dict(typed.dtypes)["Amount"] == "double"
    strings = read_csv_strings(spark, path)
    assert all(t == "string" for _, t in strings.dtypes)
    pos = with_input_position(strings, "pos").collect()
    assert sorted(r["pos"] for r in pos) == list(range(ev.count()))
    # part files are written in key order, so position follows the key order
    assert all(int(r[fx.EVENT_KEY]) == r["pos"] for r in pos)


def test_missing_input_fails_clearly(spark):
    with pytest.raises(InputNotFound):
        read_csv_table(spark, "/nonexistent/creditcard.csv")


def test_sentinel_message_counts_data(spark):
    ev = fx.event_features(spark, SF_SMALL)
    text = sentinel_message(encode_messages(ev, fx.EVENT_KEY)).first()["value"]
    assert text == '{"__sentinel":"DONE","total_published":1000}'


def test_event_time_ignores_session_zone(spark):
    utc = {r[0]: r[1] for r in fx.event_features(spark, SF_SMALL).select(fx.EVENT_KEY, "Time").collect()}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = {r[0]: r[1] for r in fx.event_features(spark, SF_SMALL).select(fx.EVENT_KEY, "Time").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == other


def test_decoded_features_follow_the_declared_schema(spark):
    from raresift.functions.schema import card_feature_names, feature_schema

    names = card_feature_names()
    assert names[0] == "Time" and names[-1] == "Amount" and len(names) == 30
    df = spark.createDataFrame([('{"Time": "1", "__id": 1}',)], "value string")
    out = decode_messages(df, names)
    assert out.select(*names).schema == feature_schema(names)


def test_csv_with_declared_schema_and_sampled_inference(spark):
    ev = fx.event_features(spark, SF_SMALL)
    path = scratch_path(spark, "csv-schema")
    ev.write.option("header", True).csv(path)
    ddl = "__id bigint, Time double, V1 double, V2 double, Amount double, label int"
    typed = read_csv_table(spark, path, schema=ddl)
    assert dict(typed.dtypes) == {"__id": "bigint", "Time": "double", "V1": "double", "V2": "double",
                                  "Amount": "double", "label": "int"}
    sampled = read_csv_table(spark, path, sampling_ratio=0.5)
    assert dict(sampled.dtypes)["Amount"] == "double"
    assert typed.count() == ev.count()
