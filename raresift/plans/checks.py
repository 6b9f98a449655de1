"""Registered queries about fits, areas, malformed input, written documents and sink layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from raresift.functions.schema import LABEL
from raresift.operators.histogram import histogram_areas, merge_histograms, score_histogram
from raresift.operators.newton import newton_fit
from raresift.operators.persist import scratch_scope
from raresift.plans.queries import EVENT_SCORER, register, stream_run, _view
from raresift.plans.training import run_training
from raresift.session import scratch_path
from raresift.sinks.compaction import DAY, compact_sink
from raresift.sources.fixtures import TXN_FEATURES, TXN_KEY, event_features, transactions
from raresift.sources.quarantine import REASON, read_csv_quarantined
from raresift.sources.tables import InputNotFound, read_csv_table, read_report
from raresift.streaming.report import flagged_rows

# Features of the Newton query, and the layouts it is fitted on.
NEWTON_FEATURES = ["V2", "Amount"]
LAYOUTS = (3, 7)
# Which rows of the CSV fixture get which fault, as (quantity, fault).
CSV_FAULTS = {13: "letters", 17: "short", 19: "long", 23: "two"}


@register("newton_weights")
def q_newton_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of a logistic regression by Newton steps, and whether two layouts give the very same (ML3)."""
    rows = event_features(spark, sf_dir)
    fits = [newton_fit(rows.repartition(n), NEWTON_FEATURES, LABEL) for n in LAYOUTS]
    same = fits[0] == fits[1]
    scorer = fits[0].scorer
    terms = [("intercept", scorer.intercept), *scorer.weights.items()]
    return spark.createDataFrame([(t, w, same) for t, w in terms], "term string, weight double, same boolean").select(
        "term", F.round("weight", 6).alias("weight"), "same"
    )


@register("binned_areas")
def q_binned_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas from a score histogram, from the whole and from parts merged (AGG6, AGG7)."""
    scored = EVENT_SCORER.score(event_features(spark, sf_dir)).select("__id", "probability", LABEL)
    whole = histogram_areas(score_histogram(scored, "probability"))
    parts = [score_histogram(scored.repartition(3 + k).filter(F.pmod("__id", F.lit(3)) == k), "probability") for k in range(3)]
    merged = histogram_areas(merge_histograms(*parts)).select(F.struct("*")).scalar()
    rounded = [F.round(c, 9).alias(c) for c in ("auc_roc", "auc_pr", "roc_error")]
    return whole.select(*rounded, "positives", "negatives", "bins", (F.to_json(F.struct("*")) == F.to_json(merged)).alias("merged_equal"))


def faulty_lines(rows: DataFrame) -> DataFrame:
    """T as CSV lines, some of them malformed."""
    names = [TXN_KEY, *TXN_FEATURES, "Class"]

    def line(**other) -> F.Column:
        return F.concat_ws(",", *[F.coalesce(other.get(n, F.col(n)).cast("string"), F.lit("")) for n in names if other.get(n, "") is not None])

    broken = {
        "letters": line(V2=F.lit("abc")),
        "short": line(Class=None),
        "long": F.concat(line(), F.lit(",7")),
        "two": line(Time=F.lit("12x"), Amount=F.lit("--")),
    }
    value = F.lit(None).cast("string")
    for quantity, fault in CSV_FAULTS.items():
        value = F.when((F.col("V1") == quantity) & (F.col("Class") == 0), broken[fault]).otherwise(value)
    return rows.select(F.coalesce(value, line()).alias("value"))


@register("csv_quarantine")
def q_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed rows of a CSV by key and reason, and the count of rows that fit (SRC1, SRC3)."""
    path = scratch_path(spark, "faulty-csv")
    faulty_lines(transactions(spark, sf_dir)).write.text(path)
    types = [StructField(TXN_KEY, StringType()), *[StructField(n, DoubleType()) for n in TXN_FEATURES], StructField("Class", IntegerType())]
    good, bad = read_csv_quarantined(spark, path, StructType(types), header=False)
    listed = bad.groupBy(TXN_KEY, REASON).agg(F.count(F.lit(1)).alias("rows"))
    return listed.unionByName(good.agg(F.lit(None).cast("string").alias(TXN_KEY), F.lit("none").alias(REASON), F.count(F.lit(1)).alias("rows")))


@register("sink_compacted")
def q_sink_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kind: rows, flagged rows and ids before and after compaction, run twice (SNK7)."""
    sink = stream_run(spark, sf_dir).sink
    path = scratch_path(spark, "compacted")
    compact_sink(sink, path)
    table = compact_sink(sink, path)  # again, as after a crash

    def figures(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy("kind").agg(
            F.count(F.lit(1)).alias(f"{prefix}rows"),
            F.count_if(F.coalesce(F.col("prediction") == 1.0, F.lit(False))).alias(f"{prefix}flagged"),
            F.coalesce(F.sum("__id"), F.lit(0).cast("long")).alias(f"{prefix}id_sum"),
        )

    pruned = flagged_rows(table.filter(F.col("kind") == "ok")).select("prediction", DAY)
    folders = pruned._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull(kind")
    return figures(sink, "").join(figures(table, "after_"), "kind").withColumn("pruned", F.lit(folders > 0))


@register("training_document")
def q_training_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training job's JSON document and CSV sample, read back from their files (SNK2, SNK3).

    One row per class of the document's profile; ``sample_labels`` are the
    labels of the sample in its order.
    """
    out = scratch_path(spark, "training")
    with scratch_scope(spark) as scope:
        run_training(
            spark, transactions(spark, sf_dir), dataset_path=f"{sf_dir}/lineitem.parquet", output_dir=out, key=[TXN_KEY], view=_view("transactions")
        )
        document = read_report(spark, f"{out}/summary")
        sample = read_csv_table(spark, f"{out}/sample_predictions", schema="label int, prediction int")
        confusion = F.aggregate("confusion_matrix", F.lit(0).cast("long"), lambda n, c: n + c["count"])
        labels = sample.agg(F.sum("label").alias("ones"), F.count("label").alias("n"))
        right = sample.agg(F.count_if(F.col("label") == F.col("prediction")) >= F.lit(0.9) * F.count(F.lit(1)))
        areas = reduce(lambda a, b: a & b, [F.col(c).between(0.0, 1.0) for c in ("area_under_roc", "area_under_pr", "exact_area_under_roc", "exact_area_under_pr")])
        shown = document.select(
            "rows_before_cleaning", "rows_after_cleaning", "train_rows", "test_rows", "sample_fraction",
            F.col("max_iter").cast("int").alias("max_iter"), "decision_threshold", areas.alias("areas_in_range"), confusion.alias("confusion_rows"),
            labels.select("n").scalar().alias("sample_rows"), labels.select("ones").scalar().alias("sample_ones"), right.scalar().alias("sample_right"),
            F.explode("sql_summary").alias("s"),
        ).select("*", F.col("s.label").cast("int").alias("label"), "s.transaction_count", "s.avg_amount", "s.max_amount").drop("s")
        return scope.result(shown, "training-document")


@register("missing_input")
def q_missing_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error that a missing table gives, by reader, beside the rows of one that is there (SRC2)."""

    def named(read) -> str:
        try:
            read()
        except InputNotFound as error:
            return type(error).__name__
        return "none"

    absent = f"{sf_dir}/no_such_table"
    schema = StructType([StructField("a", StringType())])
    found = [
        ("csv", named(lambda: read_csv_table(spark, absent))),
        ("quarantined", named(lambda: read_csv_quarantined(spark, absent, schema)[0])),
        ("report", named(lambda: read_report(spark, absent))),
    ]
    there = event_features(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows_there"))
    return spark.createDataFrame(found, "reader string, error string").withColumn("rows_there", there.scalar())
