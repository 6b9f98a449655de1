"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each builds its plan from the shared parquet tables through the package
operators; none collects rows to the driver beyond bounded one-row values.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresift.functions.expressions import SEED, alert_text
from raresift.functions.schema import LABEL, WEIGHT, card_feature_names, feature_columns
from raresift.functions.scoring import LinearScorer
from raresift.operators.clean import clean_table, sample_rows, tally_counts, tally_rows
from raresift.operators.cumulative import global_position
from raresift.operators.evaluate import binary_areas, confusion_matrix, evaluator_areas, sample_predictions
from raresift.operators.events import decode_messages, encode_messages, with_input_position
from raresift.operators.model import fit_classifier, fit_scaler, load_model, save_model, scaler_deviations, score
from raresift.operators.persist import materialize, scratch_scope
from raresift.operators.profile import class_profile, class_weights, with_class_weight
from raresift.operators.split import split_counts, train_test_split
from raresift.plans.streaming_job import ScoringOutput, publish, run_stream_scoring
from raresift.plans.training import run_training
from raresift.session import scratch_path
from raresift.sources.fixtures import (
    CARD_KEY,
    EVENT_FEATURES,
    EVENT_KEY,
    MESSAGE_TIME_STEP,
    TXN_KEY,
    card_features,
    event_features,
    event_messages,
    transactions,
)
from raresift.sources.tables import read_csv_strings, read_csv_table, read_report
from raresift.streaming.report import report_frauds, unique_by
from raresift.streaming.scorer import score_messages

# Constant scorers of the oracle-checked scoring queries
# (weights on raw, unscaled features; threshold 0.7 as in the training job).
TXN_SCORER = LinearScorer(intercept=-40.0, weights={"V1": 0.5, "V2": 200.0}, threshold=0.7)
EVENT_SCORER = LinearScorer(
    intercept=-9.5, weights={"V1": 0.002, "V2": 0.004, "Amount": 0.05}, threshold=0.7
)
# Fixed value: the area that the fitted model must reach on held-out rows.
AREA_FLOOR = 0.99
# Fixed value: fraction of the sampling query.
SAMPLE_FRACTION = 0.3

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


def scoped(fn: QueryFn) -> QueryFn:
    """A query whose tables on the way are deleted when its result is written, and after an error."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scratch_scope(spark) as scope:
            return scope.result(fn(spark, sf_dir), fn.__name__)

    return run


def clean_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_table(transactions(spark, sf_dir))


@register("clean_transactions")
def q_clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_fixture(spark, sf_dir)


@register("clean_counts")
def q_clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after cleaning from one pass: the copy tally of the input."""
    return tally_counts(tally_rows(transactions(spark, sf_dir)))


def _view(prefix: str) -> str:
    """A temp-view name of its own, so queries sharing a session never clash."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@register("class_profile")
def q_class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_profile(spark, clean_fixture(spark, sf_dir), view=_view("transactions"))


@register("class_weights")
def q_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_weights(clean_fixture(spark, sf_dir), LABEL)


@register("sample_fraction")
def q_sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(transactions(spark, sf_dir), SAMPLE_FRACTION, SEED, key=[TXN_KEY])


@register("train_test_counts")
def q_train_test_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_counts(clean_fixture(spark, sf_dir), TXN_KEY, LABEL)


def scored_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows of clean T scored by the constant scorer."""
    _, test = train_test_split(clean_fixture(spark, sf_dir), TXN_KEY)
    return TXN_SCORER.score(test)


@register("score_closed_form")
def q_score_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_test(spark, sf_dir).select(
        TXN_KEY, LABEL, F.round("probability", 6).alias("probability"), "prediction"
    )


@register("confusion_matrix")
def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(scored_test(spark, sf_dir))


@register("sample_predictions")
def q_sample_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_predictions(scored_test(spark, sf_dir), TXN_KEY, 50)


@register("flagged_alerts")
def q_flagged_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = scored_test(spark, sf_dir).filter(F.col("prediction") == 1.0)
    return flagged.select(
        TXN_KEY,
        alert_text("Time", "Amount").alias("alert"),
        "Time",
        "Amount",
        "prediction",
    )


def event_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_areas(event_features(spark, sf_dir), "Amount", "label")


@register("auc_roc")
def q_auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_areas(spark, sf_dir).select(F.round("auc_roc", 9).alias("auc_roc"), "positives", "negatives")


@register("auc_pr")
def q_auc_pr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_areas(spark, sf_dir).select(F.round("auc_pr", 9).alias("auc_pr"), "positives", "negatives")


def fitted_fixture(spark: SparkSession, sf_dir: str):
    """Weighted clean T (written once), split by key, and the pipeline fitted on its train rows."""
    clean = materialize(clean_fixture(spark, sf_dir), "clean")
    weighted = with_class_weight(clean)
    train, test = train_test_split(weighted, TXN_KEY)
    features = feature_columns(weighted, exclude=(LABEL, WEIGHT), extra_exclude=[TXN_KEY])
    return fit_classifier(train, features), features, train, test


@register("scaler_std")
def q_scaler_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = with_class_weight(clean_fixture(spark, sf_dir))
    train, _ = train_test_split(weighted, TXN_KEY)
    features = feature_columns(weighted, exclude=(LABEL, WEIGHT), extra_exclude=[TXN_KEY])
    rows = scaler_deviations(fit_scaler(train, features), features)
    return spark.createDataFrame(rows, "feature string, std double").select(
        "feature", F.round("std", 6).alias("std")
    )


@register("fit_quality")
@scoped
def q_fit_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on either side, whether the exact areas equal the evaluator's, and whether they reach a floor."""
    model, _, train, test = fitted_fixture(spark, sf_dir)
    scored = score(model, test).select(LABEL, "rawPrediction", "p_positive")
    predictions = materialize(scored, "fit-predictions")
    roc, pr = evaluator_areas(predictions, num_bins=0)
    exact = binary_areas(predictions, "p_positive", LABEL)
    same = (F.abs(F.col("auc_roc") - F.lit(roc)) < 1e-9) & (F.abs(F.col("auc_pr") - F.lit(pr)) < 1e-9)
    return exact.select(
        train.agg(F.count(F.lit(1))).scalar().alias("train_rows"),
        (F.col("positives") + F.col("negatives")).alias("test_rows"),
        same.alias("areas_agree"),
        (F.col("auc_roc") > AREA_FLOOR).alias("above_floor"),
    )


def compared(scored: DataFrame, model) -> DataFrame:
    """One row: how many scored rows ``model`` scores again, and how many of them differently."""
    again = score(model, scored.withColumnsRenamed({"p_positive": "p_before", "prediction": "before"}), "p_after")
    apart = (F.abs(F.col("p_after") - F.col("p_before")) > 1e-12) | (F.col("before") != F.col("prediction"))
    return again.agg(F.count(F.lit(1)).alias("rows_compared"), F.count_if(apart).alias("rows_differing"))


@register("model_roundtrip")
@scoped
def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows scored by the fitted pipeline and by the same one saved and loaded."""
    model, _, _, test = fitted_fixture(spark, sf_dir)
    loaded = load_model(save_model(model, scratch_path(spark, "model")))
    return compared(score(model, test).select(*test.columns, "p_positive", "prediction"), loaded)


@register("training_summary")
@scoped
def q_training_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training job's document, one row per class, with the rows of its CSV sample read back."""
    out = scratch_path(spark, "training")
    result = run_training(
        spark,
        transactions(spark, sf_dir),
        dataset_path=f"{sf_dir}/lineitem.parquet",
        output_dir=out,
        key=[TXN_KEY],
        view=_view("transactions"),
    )
    sample = read_csv_table(spark, f"{out}/sample_predictions", schema="label int, prediction int")
    return result.summary.select(
        "rows_before_cleaning", "rows_after_cleaning", "train_rows", "test_rows", "sample_fraction", "max_iter",
        "decision_threshold", F.explode("sql_summary").alias("s"),
        F.aggregate("confusion_matrix", F.lit(0).cast("long"), lambda n, c: n + c["count"]).alias("confusion_rows"),
        sample.agg(F.count_if(F.col("label").isin(0, 1) & F.col("prediction").isin(0, 1))).scalar().alias("sample_rows"),
    ).select("*", "s.*").drop("s")


@register("event_time_positions")
def q_event_time_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's 0-based position in time order, computed without a global sort."""
    return global_position(event_features(spark, sf_dir), "Time", "position", tie_breaker=[EVENT_KEY]).select(
        EVENT_KEY, "position"
    )


@register("encode_events")
def q_encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip: rows -> JSON text messages -> parsed rows."""
    messages = encode_messages(event_features(spark, sf_dir), EVENT_KEY, EVENT_FEATURES + ["label"])
    decoded = decode_messages(messages, EVENT_FEATURES, passthrough=["label"])
    return decoded.select(EVENT_KEY, *EVENT_FEATURES, F.col("label").try_cast("int").alias("label"))


@register("decode_events")
def q_decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery of the faulty message fixture, parsed and routed (batch)."""
    m = event_messages(spark, sf_dir)
    deliveries = m["first"].unionByName(m["body"]).unionByName(m["redelivered"])
    decoded = decode_messages(deliveries, EVENT_FEATURES)
    # Features of quarantined rows are not data (their text and reason are);
    # they are shown only for rows ready to score.
    ok = F.col("kind") == "ok"
    return decoded.select(
        EVENT_KEY, "kind", "reason", *[F.when(ok, F.col(c)).alias(c) for c in EVENT_FEATURES], "total_published"
    )


def published_events(spark: SparkSession, sf_dir: str) -> str:
    """Write the message fixture as files: sentinel first, repeats last."""
    m = event_messages(spark, sf_dir)
    return publish([m["first"], m["body"], m["redelivered"]], scratch_path(spark, "messages"))


def stream_run(spark: SparkSession, sf_dir: str, dedupe_delay: str | None = None, report: bool = False) -> ScoringOutput:
    work = scratch_path(spark, "stream")
    out = run_stream_scoring(
        spark,
        published_events(spark, sf_dir),
        work,
        EVENT_FEATURES,
        EVENT_SCORER,
        passthrough=["label"],
        dedupe_delay=dedupe_delay,
        report_path=f"{work}/report" if report else None,
    )
    return complete(out)


def complete(out: ScoringOutput) -> ScoringOutput:
    """The output of a run that read its whole source; a cut run is an error."""
    if not out.run.finished:
        raise RuntimeError("STREAM_CUT: the run was stopped before it had read all messages")
    return out


@register("stream_scored")
def q_stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = stream_run(spark, sf_dir).sink
    return sink.filter(F.col("kind") == "ok").select(
        EVENT_KEY, F.round("probability", 6).alias("probability"), "prediction"
    )


@register("stream_report")
def q_stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = stream_run(spark, sf_dir).report
    return report.drop("frauds", "elapsed_seconds")


def report_document(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Run the stream, write its report, and read the document and the flagged table back (SNK4, SRC8)."""
    work = stream_run(spark, sf_dir, report=True)
    path = work.run.sink_path.rsplit("/", 1)[0] + "/report"
    return read_report(spark, path), spark.read.parquet(f"{path}-flagged")


@register("report_fields")
def q_report_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc, _ = report_document(spark, sf_dir)
    return doc.select("frauds_flagged_count", "total_messages_seen", "sentinel_total_published")


@register("report_frauds")
def q_report_frauds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's list of flagged deliveries, entry by entry (AGG12, LIM2, PRJ8)."""
    doc, _ = report_document(spark, sf_dir)
    return report_frauds(doc, [EVENT_KEY, *EVENT_FEATURES, "prediction"])


@register("unique_by_time")
def q_unique_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of all flagged deliveries for each ``Time`` (DUP2)."""
    _, flagged = report_document(spark, sf_dir)
    return unique_by(flagged, "Time", ["arrived_at", EVENT_KEY]).select("Time", EVENT_KEY, "Amount", "prediction")


@register("stream_alerts")
def q_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live notices of the flagged deliveries, as the stream wrote them (SNK6, FN7)."""
    sink = stream_run(spark, sf_dir).sink
    return sink.filter(F.col("alert").isNotNull()).select(EVENT_KEY, "alert")


@register("stream_dedup")
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = stream_run(spark, sf_dir, dedupe_delay="10 minutes").sink
    return sink.select(EVENT_KEY, "kind", "reason")


@register("csv_class_profile")
def q_csv_class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile read through a headed CSV with inferred types (SRC1)."""
    path = scratch_path(spark, "transactions-csv")
    transactions(spark, sf_dir).write.option("header", True).csv(path)
    raw = read_csv_table(spark, path, infer_schema=True)
    return class_profile(spark, clean_table(raw), view=_view("transactions_csv"))


@register("published_positions")
def q_published_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-less CSV -> input position as ``__id`` -> JSON messages -> parsed (SRC3, PRJ7, SNK5)."""
    path = scratch_path(spark, "events-csv")
    feats = event_features(spark, sf_dir).orderBy(EVENT_KEY)
    feats.drop(EVENT_KEY).write.option("header", True).csv(path)
    rows = with_input_position(read_csv_strings(spark, path), EVENT_KEY)
    decoded = decode_messages(encode_messages(rows, EVENT_KEY), EVENT_FEATURES, passthrough=["label"])
    return decoded.select(EVENT_KEY, "kind", *EVENT_FEATURES, F.col("label").try_cast("int").alias("label"))


@register("stream_model_scored")
@scoped
def q_stream_model_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream scored by a saved MLlib pipeline, against the same model on the event table (ML6, SRC7).

    Per kind of message: deliveries, and how many of them differ from the batch score of their id.
    """
    step = float(MESSAGE_TIME_STEP)
    events = event_features(spark, sf_dir).withColumn("Time", F.floor(F.col("Time") / step) * step)
    model = fit_classifier(with_class_weight(events.drop(EVENT_KEY)), EVENT_FEATURES)
    loaded = load_model(save_model(model, scratch_path(spark, "event-model")))
    out = complete(
        run_stream_scoring(
            spark, published_events(spark, sf_dir), scratch_path(spark, "stream-model"),
            EVENT_FEATURES, loaded, passthrough=["label"],
        )
    )
    batch = score(model, events).select(EVENT_KEY, "p_positive", F.col("prediction").alias("batch_prediction"))
    both = out.sink.join(batch, EVENT_KEY, "left")
    same = (F.abs(F.col("probability") - F.col("p_positive")) < 1e-12) & (F.col("prediction") == F.col("batch_prediction"))
    wrong = F.when(F.col("kind") == "ok", ~F.coalesce(same, F.lit(False))).otherwise(F.col("prediction").isNotNull())
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("rows_differing"))


# A constant scorer over the 30 features of the card layout.
CARD_SCORER = LinearScorer(
    intercept=-3.0, weights={"Time": 1e-4, "Amount": 1e-5} | {f"V{i}": 0.01 * i for i in range(1, 29)}, threshold=0.7
)


@register("card_messages_scored")
def q_card_messages_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 30 features of the card layout: rows -> JSON messages -> parsed -> scored (SRC6)."""
    rows = card_features(spark, sf_dir)
    messages = encode_messages(rows, CARD_KEY, card_feature_names())
    scored = score_messages(messages, card_feature_names(), CARD_SCORER)
    return scored.filter(F.col("kind") == "ok").select(
        F.col("__id").alias(CARD_KEY), F.round("probability", 6).alias("probability"), "prediction", "alert"
    )


__all__ = ["QUERIES", "TXN_KEY", "TXN_SCORER", "EVENT_SCORER"]
