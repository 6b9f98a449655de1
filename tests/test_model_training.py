import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from raresift.functions.schema import LABEL, WEIGHT, feature_columns
from raresift.functions.scoring import LinearScorer
from raresift.operators.clean import clean_table
from raresift.operators.evaluate import binary_areas
from raresift.operators.model import fit_classifier, load_model, save_model, scaler_deviations, score
from raresift.operators.profile import with_class_weight
from raresift.operators.split import train_test_split
from raresift.plans.training import run_training
from raresift.session import scratch_path
from raresift.sources.fixtures import TXN_KEY, transactions
from raresift.sources.tables import read_report


@pytest.fixture(scope="module")
def fitted(spark):
    weighted = with_class_weight(clean_table(transactions(spark, SF_MID)))
    train, test = train_test_split(weighted, TXN_KEY)
    feats = feature_columns(weighted, exclude=(LABEL, WEIGHT), extra_exclude=[TXN_KEY])
    return fit_classifier(train, feats), feats, train, test


def test_fit_quality_floor(fitted):
    model, _, _, test = fitted
    row = binary_areas(score(model, test), "p_positive", LABEL).first()
    assert row["auc_roc"] > 0.99
    assert row["auc_pr"] > 0.5


def test_scaler_std_is_stddev_samp(fitted):
    model, feats, train, _ = fitted
    stds = dict(scaler_deviations(model, feats))
    want = train.agg(*[F.stddev_samp(c).alias(c) for c in feats]).first()
    for c in feats:
        assert stds[c] == pytest.approx(want[c], rel=1e-12)


def test_closed_form_equals_pipeline(fitted):
    model, feats, _, test = fitted
    scorer = LinearScorer.from_pipeline_model(model, feats)
    assert scorer.threshold == 0.7
    a = score(model, test).select(TXN_KEY, "p_positive", "prediction")
    b = scorer.score(test).select(TXN_KEY, F.col("probability").alias("p2"), F.col("prediction").alias("pred2"))
    rows = a.join(b, TXN_KEY).collect()
    assert len(rows) == test.count()
    assert all(abs(r["p_positive"] - r["p2"]) < 1e-9 for r in rows)
    assert sum(r["prediction"] != r["pred2"] for r in rows) == 0


def test_prediction_is_probability_above_threshold(fitted):
    model, _, _, test = fitted
    s = score(model, test)
    bad = s.filter((F.col("prediction") == 1.0) != (F.col("p_positive") > 0.7)).count()
    assert bad == 0


def test_model_save_load_roundtrip(spark, fitted):
    model, _, _, test = fitted
    path = save_model(model, scratch_path(spark, "model-test"))
    save_model(model, path)  # overwrite is allowed
    loaded = load_model(path)
    a = {r[TXN_KEY]: r["prediction"] for r in score(model, test).select(TXN_KEY, "prediction").collect()}
    b = {r[TXN_KEY]: r["prediction"] for r in score(loaded, test).select(TXN_KEY, "prediction").collect()}
    assert a == b


def test_training_job_outputs(spark):
    out = scratch_path(spark, "training-test")
    model_dir = scratch_path(spark, "training-model")
    result = run_training(
        spark, transactions(spark, SF_SMALL), dataset_path="lineitem", output_dir=out,
        model_output_dir=model_dir, key=[TXN_KEY],
    )
    doc = read_report(spark, f"{out}/summary").first()
    assert doc["rows_before_cleaning"] == transactions(spark, SF_SMALL).count()
    assert doc["train_rows"] + doc["test_rows"] == doc["rows_after_cleaning"]
    assert doc["max_iter"] == 10 and doc["decision_threshold"] == 0.7
    assert [r["label"] for r in doc["sql_summary"]] == [0, 1]
    assert sum(r["count"] for r in doc["confusion_matrix"]) == doc["test_rows"]
    sample = spark.read.option("header", True).csv(f"{out}/sample_predictions")
    assert sample.columns == ["label", "prediction"]
    assert 0 < sample.count() <= 50
    assert load_model(model_dir) is not None
    assert result.feature_cols == ["Time", "V1", "V2", "V3", "Amount"]


def test_training_with_sample_fraction(spark):
    raw = transactions(spark, SF_MID)
    result = run_training(spark, raw, key=[TXN_KEY], sample_fraction=0.5)
    doc = result.summary.first()
    assert 0.4 * raw.count() < doc["rows_before_cleaning"] < 0.6 * raw.count()
    assert doc["sample_fraction"] == 0.5


def test_training_with_one_class_test_split(spark):
    raw = transactions(spark, SF_SMALL)
    result = run_training(spark, raw, key=[TXN_KEY], sample_fraction=0.5)
    assert result.summary.count() == 1


def test_fit_on_natural_labels(spark):
    """Unseparated documents: the fit runs, weights follow the class ratio."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    table = labels.join(docs, "doc_id").select(
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("words"),
        F.col("toxic").alias("label"),
    )
    weighted = with_class_weight(table)
    counts = table.groupBy("label").count().collect()
    c = {r["label"]: r["count"] for r in counts}
    assert c[1] == 51 and c[0] + c[1] == 399
    w = weighted.filter("label = 1").first()["weight"]
    assert w == pytest.approx((c[0] / c[1]) ** 0.5)
    model = fit_classifier(weighted, ["n_chars", "words"])
    row = binary_areas(score(model, weighted), "p_positive", LABEL).first()
    assert 0.0 <= row["auc_roc"] <= 1.0 and row["positives"] == 51


def test_the_fit_reads_features_and_the_written_side_of_the_split(spark, monkeypatch):
    from raresift.plans import training

    seen, fit = [], training.fit_classifier
    monkeypatch.setattr(training, "fit_classifier", lambda train, *a, **k: (seen.append(train), fit(train, *a, **k))[1])
    raw = spark.createDataFrame([(f"k{i}", float(i % 9), float(i % 4), int(i % 5 == 0)) for i in range(200)], "k string, a double, Amount double, Class int")
    run_training(spark, raw, key=["k"], max_iter=2)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan
    physical = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:double,Amount:double,Class:int," in physical
