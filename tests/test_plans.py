"""Plan properties that matter at scale, checked on the physical plans."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from raresift.operators.clean import clean_tally, tally_rows
from raresift.operators.persist import materialize
from raresift.operators.profile import class_profile
from raresift.plans.queries import QUERIES
from raresift.sources.fixtures import transactions
from raresift.streaming.report import report_counts

BATCH = [
    "clean_transactions", "clean_counts", "class_profile", "class_weights", "sample_fraction",
    "train_test_counts", "score_closed_form", "confusion_matrix", "sample_predictions",
    "flagged_alerts", "auc_roc", "auc_pr", "encode_events", "decode_events", "card_messages_scored",
    "event_time_positions",
]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan(QUERIES[k](spark, SF_SMALL)) for k in BATCH}


def test_no_cross_joins_and_no_python(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name
        assert "EvalPython" not in text and "InPandas" not in text, name


def test_scans_are_pruned(plans):
    for name in ["clean_transactions", "class_profile", "score_closed_form"]:
        text = plans[name]
        assert "l_returnflag" not in text and "l_linestatus" not in text, name
    assert "ReadSchema: struct<event_type:string,value:double>" in plans["auc_roc"]


def test_profile_reads_two_columns_of_the_cleaned_table(spark):
    tally = materialize(tally_rows(transactions(spark, SF_SMALL)), "tally")
    text = plan(class_profile(spark, clean_tally(tally)))
    assert re.findall(r"ReadSchema: (\S+)", text) == ["struct<Amount:double,Class:int>"]


def test_class_weights_read_the_input_once(plans):
    tree = plans["class_weights"].split("\n\n")[0]
    assert tree.count("Scan parquet") == 2  # the two sides of the fixture's union


def test_report_counts_copy_no_rows(spark):
    sink = spark.createDataFrame([], "kind string, prediction double, Time double, __id long, total_published long")
    assert "Expand" not in plan(report_counts(sink))


def test_filters_reach_the_scan(plans):
    assert "PushedFilters: [IsNotNull(l_quantity), EqualTo(l_quantity,7.0)]" in plans["clean_transactions"]
    assert "Not(In(event_id, [13,17,19,23,29,31,37]))" in plans["decode_events"]


def test_sample_and_split_are_narrow(plans):
    main = plans["sample_fraction"].split("\n\n")[0]
    assert "Exchange" not in main


def test_auc_broadcasts_only_the_bucket_offsets(plans):
    text = plans["auc_roc"]
    assert text.count("BroadcastExchange") >= 1
    # the running sums are a window partitioned by bucket, never an unpartitioned global one
    assert "Window" in text and "_rs_bucket" in text


def test_dedup_aggregates_map_side(plans):
    tree = plans["clean_transactions"].split("\n\n")[0]
    # the tree prints root first: final aggregate, exchange, then the map-side partial one
    assert tree.index("HashAggregate") < tree.index("Exchange") < tree.rindex("HashAggregate")


def test_a_message_is_parsed_once(spark):
    """A filter on the decoded kind must not copy the parsing into itself."""
    text = QUERIES["card_messages_scored"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1
    assert text.count("try_cast(_m") <= 31  # thirty features and the id


def test_the_code_of_thirty_features_is_small_enough_to_be_compiled(spark):
    """The JVM runs methods of over 8000 bytes of bytecode in its interpreter only."""
    QUERIES["card_messages_scored"](spark, SF_SMALL).createOrReplaceTempView("card_scored_plan")
    try:
        text = spark.sql("EXPLAIN CODEGEN SELECT * FROM card_scored_plan").first()[0]
    finally:
        spark.catalog.dropTempView("card_scored_plan")
    found = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert found and max(found) < 8000
