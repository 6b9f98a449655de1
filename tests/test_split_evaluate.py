import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from raresift.operators.clean import clean_table
from raresift.operators.cumulative import global_position, running_totals
from raresift.operators.evaluate import binary_areas, confusion_matrix, sample_predictions
from raresift.operators.split import train_test_split
from raresift.sources.fixtures import TXN_KEY, event_features, transactions


def test_split_is_layout_independent_and_disjoint(spark):
    clean = clean_table(transactions(spark, SF_SMALL))
    tr3, te3 = train_test_split(clean.repartition(3), TXN_KEY)
    tr7, _ = train_test_split(clean.repartition(7), TXN_KEY)
    k3 = {r[0] for r in tr3.select(TXN_KEY).collect()}
    k7 = {r[0] for r in tr7.select(TXN_KEY).collect()}
    assert k3 == k7
    assert not k3 & {r[0] for r in te3.select(TXN_KEY).collect()}
    assert 0.75 < len(k3) / clean.count() < 0.85


def _evaluator(df, metric):
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="Amount", metricName=metric, numBins=0
    ).evaluate(df.withColumn("label", F.col("label").cast("double")))


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_exact_areas_match_evaluator(spark, buckets):
    ev = event_features(spark, SF_MID)
    row = binary_areas(ev, "Amount", "label", num_buckets=buckets).first()
    assert row["auc_roc"] == pytest.approx(_evaluator(ev, "areaUnderROC"), abs=1e-12)
    assert row["auc_pr"] == pytest.approx(_evaluator(ev, "areaUnderPR"), abs=1e-12)
    assert round(row["auc_roc"], 9) == 0.498168157


def test_areas_with_all_scores_tied(spark):
    ev = event_features(spark, SF_SMALL).withColumn("Amount", F.lit(1.0))
    row = binary_areas(ev, "Amount", "label").first()
    assert row["auc_roc"] == pytest.approx(0.5)
    p = row["positives"] / (row["positives"] + row["negatives"])
    assert row["auc_pr"] == pytest.approx(p)


def test_areas_without_positives_are_null(spark):
    ev = event_features(spark, SF_SMALL).withColumn("label", F.lit(0))
    assert binary_areas(ev, "Amount", "label").first()["auc_roc"] is None


def test_running_totals_match_plain_window(spark):
    from pyspark.sql import Window

    ev = event_features(spark, SF_SMALL).select("__id", F.lit(1).alias("one"), "Amount")
    got = running_totals(ev, "__id", ["one", "Amount"], num_buckets=5)
    w = Window.orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    want = ev.select("__id", F.sum("one").over(w).alias("c1"), F.sum("Amount").over(w).alias("c2"))
    g = {r["__id"]: (r["cum_one"], r["cum_Amount"]) for r in got.collect()}
    for r in want.collect():
        assert g[r["__id"]][0] == r["c1"]
        assert g[r["__id"]][1] == pytest.approx(r["c2"], rel=1e-12)


def test_confusion_and_sample(spark):
    from raresift.plans.queries import TXN_SCORER

    clean = clean_table(transactions(spark, SF_SMALL))
    scored = TXN_SCORER.score(clean)
    cm = confusion_matrix(scored).collect()
    assert sum(r["count"] for r in cm) == clean.count()
    assert [(r["label"], r["prediction"]) for r in cm] == sorted((r["label"], r["prediction"]) for r in cm)
    sample = sample_predictions(scored, TXN_KEY, 50).collect()
    assert len(sample) == 50
    assert [r[TXN_KEY] for r in sample] == sorted(r[TXN_KEY] for r in sample)


@pytest.mark.parametrize("buckets", [1, 7])
def test_global_position_equals_row_number(spark, buckets):
    from pyspark.sql import Window

    from raresift.operators.cumulative import global_position

    ev = event_features(spark, SF_SMALL)
    got = {r["__id"]: r["position"] for r in global_position(ev, "Time", num_buckets=buckets).collect()}
    w = Window.orderBy("Time")
    want = {r["__id"]: r["p"] for r in ev.select("__id", (F.row_number().over(w) - 1).alias("p")).collect()}
    assert got == want


def test_bucket_count_is_bounded(spark):
    from raresift.operators.cumulative import MAX_BUCKETS

    ev = event_features(spark, SF_SMALL)
    with pytest.raises(ValueError):
        running_totals(ev, "Time", ["Amount"], num_buckets=MAX_BUCKETS + 1)


def test_split_keeps_rows_with_a_null_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    train, test = train_test_split(df, "k")
    assert sorted(r.v for r in train.union(test).collect()) == [1, 2, 3]
    assert 2 in {r.v for r in test.collect()}


def test_positions_need_values_and_order_ties(spark):
    rows = [(float(i % 3), i) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, i int").repartition(5)
    got = {r.i: r.position for r in global_position(df, "x", tie_breaker=["i"], num_buckets=4).collect()}
    want = {i: at for at, (_, i) in enumerate(sorted(rows))}
    assert got == want
    with pytest.raises(Exception, match="NULL_ORDER_KEY"):
        global_position(df.union(spark.createDataFrame([(None, 99)], "x double, i int")), "x").count()
