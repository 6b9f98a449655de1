"""Newton fits, mergeable areas, quarantined rows, compaction and scratch scopes."""

import math
import os
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from raresift.operators.evaluate import binary_areas
from raresift.operators.histogram import histogram_areas, merge_histograms, score_histogram
from raresift.operators.model import fit_classifier
from raresift.operators.newton import _sums, newton_fit
from raresift.operators.persist import discard, materialize, scratch_scope
from raresift.session import ensure_checkpoint_dir, scratch_path
from raresift.sinks.compaction import compact_sink
from raresift.sources import fixtures as fx
from raresift.sources.quarantine import read_csv_quarantined
from raresift.sources.tables import InputNotFound


# ---- Newton -----------------------------------------------------------------


def numpy_newton(x, y, w, ridge=0.0):
    scale = x.std(axis=0, ddof=1)
    a = np.column_stack([np.ones(len(x)), x / scale])
    penalty = np.diag([0.0] + [ridge] * x.shape[1])
    b = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ b))
        gradient = a.T @ (w * (p - y)) / w.sum() + penalty @ b
        gram = (a * (w * p * (1 - p))[:, None]).T @ a / w.sum() + penalty
        b = b - np.linalg.solve(gram, gradient)
    return [b[0], *(b[1:] / scale)]


def sample(spark, n=700, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 50, 0.01] + [0, 1000, 5]
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - (x[:, 1] - 1000) / 40)))).astype(float)
    w = rng.integers(1, 5, n).astype(float)
    rows = [(*map(float, r), float(t), float(u)) for r, t, u in zip(x, y, w)]
    return spark.createDataFrame(rows, "a double, b double, c double, label double, weight double"), x, y, w


@pytest.mark.parametrize("ridge", [0.0, 0.1])
def test_newton_equals_numpy_and_mllib(spark, ridge):
    df, x, y, w = sample(spark)
    fit = newton_fit(df, ["a", "b", "c"], weight="weight", ridge=ridge)
    got = [fit.scorer.intercept, *fit.scorer.weights.values()]
    assert got == pytest.approx(numpy_newton(x, y, w, ridge), rel=1e-7)
    assert fit.steps < 15
    if not ridge:
        from raresift.functions.scoring import LinearScorer

        model = LinearScorer.from_pipeline_model(fit_classifier(df, ["a", "b", "c"], max_iter=200), ["a", "b", "c"])
        assert got[1:] == pytest.approx(list(model.weights.values()), rel=1e-3)


def test_newton_is_the_same_on_any_layout(spark):
    df, *_ = sample(spark)
    fits = [newton_fit(df.repartition(n, F.rand(n)), ["a", "b", "c"], weight="weight") for n in (1, 3, 7)]
    assert fits[0] == fits[1] == fits[2]


def test_newton_sums_in_longs_only(spark, monkeypatch):
    df, *_ = sample(spark, n=80)
    found, agg = [], type(df).agg

    def seen(self, *columns):
        out = agg(self, *columns)
        found.extend(out.dtypes)
        return out

    monkeypatch.setattr(type(df), "agg", seen)
    newton_fit(df, ["a", "b"])
    assert found and {kind for _, kind in found} == {"bigint"}


def test_fixed_point_sums_are_exact_in_any_order(spark):
    values = [2.0**70, 0.1, -3.7e12, 5e-324, 2.0**-50, -(2.0**70), 123456.789, -0.1, 1e5 / 3, float("inf"), None, float("nan")]
    kept = [v for v in values if v is not None and math.isfinite(v)]
    exact = float(sum(Fraction(round(Fraction(v) * 2**50), 2**50) for v in kept))
    for order in (values, values[::-1]):
        rows = spark.createDataFrame([(v,) for v in order], "v double").repartition(3)
        assert _sums(rows, lambda at: [at["v"], np.ones(len(at["v"]))], 2) == [exact, float(len(values))]
    assert _sums(rows.limit(0), lambda at: [at["v"]], 1) == [0.0]


def test_newton_leaves_out_incomplete_rows_and_names_its_errors(spark):
    df, *_ = sample(spark)
    dirty = df.unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1.0), (1.0, float("nan"), 1.0, 0.0, 1.0), (1.0, 1.0, 1.0, None, 1.0)], df.schema))
    assert newton_fit(dirty, ["a", "b"]) == newton_fit(df, ["a", "b"])
    with pytest.raises(ValueError, match="NO_UNIQUE_FIT"):
        newton_fit(df.withColumn("d", F.col("a") * 2), ["a", "d"])
    with pytest.raises(ValueError, match="NO_UNIQUE_FIT"):
        newton_fit(df.withColumn("label", (F.col("a") > 0).cast("double")), ["a"])
    with pytest.raises(ValueError, match="EMPTY_FIT"):
        newton_fit(df.limit(0), ["a"])
    assert newton_fit(df.withColumn("label", (F.col("a") > 0).cast("double")), ["a"], ridge=0.01).scorer.weights["a"] > 0


# ---- areas ------------------------------------------------------------------


def test_histogram_areas_bound_the_exact_ones(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(s), int(rng.random() < s)) for i, s in enumerate(rng.random(3000))] + [(-1, None, 1), (-2, float("nan"), 0)]
    df = spark.createDataFrame(rows, "id long, s double, label int")
    exact = binary_areas(df.filter("NOT isnan(s)"), "s").first()
    for width in (0.1, 0.01, 0.001):
        got = histogram_areas(score_histogram(df, "s", width=width)).first()
        assert abs(got.auc_roc - exact.auc_roc) <= got.roc_error <= width
        assert abs(got.auc_pr - exact.auc_pr) < 3 * width
        assert (got.positives, got.negatives) == (exact.positives, exact.negatives) and got.bins <= round(1 / width) + 1


def test_histograms_merge(spark):
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(1000)) / 999).alias("s"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    whole = {tuple(r) for r in score_histogram(df, "s").collect()}
    parts = [score_histogram(df.repartition(2 + k).filter(F.floor(F.col("s") * 10) % 3 == k), "s") for k in range(3)]
    assert {tuple(r) for r in merge_histograms(*parts).collect()} == whole
    one = histogram_areas(score_histogram(df.filter("label = 1"), "s")).first()
    assert one.auc_roc is None and one.roc_error is None
    assert histogram_areas(score_histogram(df.limit(0), "s")).first().bins == 0


# ---- quarantine ---------------------------------------------------------------


def test_malformed_rows_and_reasons(spark):
    path = scratch_path(spark, "csv")
    lines = ["key,n,x,d", "a,1,2.5,2024-01-02", "b,,,", "c,1.5,2,2024-01-02", "d,1,zz,2024-13-40", "e,1", "f,1,2,2024-01-02,9", '"g,h",4,5e3,2024-02-29', "i,99999999999,1,2024-01-01"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    schema = StructType([StructField("key", StringType()), StructField("n", IntegerType()), StructField("x", DoubleType()), StructField("d", DateType())])
    good, bad = read_csv_quarantined(spark, path, schema)
    assert sorted(r.key for r in good.collect()) == ["a", "b", "g,h"]
    assert {r.key: r.reason for r in bad.collect()} == {
        "c": "n:not_a_int", "d": "x:not_a_double,d:not_a_date", "e": "too_few_fields", "f": "too_many_fields", "i": "n:not_a_int",
    }
    # what a caller selects changes nothing
    assert sorted(r.line for r in bad.select("line").collect()) == sorted(lines[i] for i in (3, 4, 5, 6, 8))
    assert good.select("key").count() == 3 and bad.count() == 5
    with pytest.raises(InputNotFound):
        read_csv_quarantined(spark, path + "-absent", schema)


# ---- compaction ---------------------------------------------------------------


def test_compaction_prunes_and_repeats(spark):
    rows = [(i, "ok" if i % 10 else "bad", 1.0 if i % 50 == 1 else 0.0, f"2024-01-0{1 + i % 3} 10:00:00") for i in range(600)]
    sink = spark.createDataFrame(rows, "__id long, kind string, prediction double, at string").select(
        "__id", "kind", "prediction", F.to_timestamp("at").alias("arrived_at")
    )
    path = scratch_path(spark, "compacted")
    for _ in range(2):
        table = compact_sink(sink.repartition(20), path)
        assert sorted(map(tuple, table.select(*sink.columns).collect())) == sorted(map(tuple, sink.collect()))
    flagged = table.filter((F.col("kind") == "ok") & (F.col("prediction") == 1.0) & (F.col("arrived_day") == "2024-01-02"))
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and "(arrived_day" in plan.split("PartitionFilters")[1]
    # one day again, with a row more: the other days stay
    more = sink.unionByName(spark.createDataFrame([(1000, "ok", 0.0, rows[0][3])], "__id long, kind string, prediction double, at string").select(
        "__id", "kind", "prediction", F.to_timestamp("at").alias("arrived_at")))
    assert compact_sink(more, path, days=["2024-01-01"]).count() == 601
    files = [f for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 12


# ---- scratch ------------------------------------------------------------------


def tables(spark):
    folder = f"{ensure_checkpoint_dir(spark)}/raresift"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_scope_leaves_its_result_only(spark):
    before = tables(spark)
    with scratch_scope(spark) as scope:
        a = materialize(spark.range(10), "a")
        with scratch_scope(spark) as inner:
            b = inner.result(materialize(a.selectExpr("id * 2 AS id"), "b"))
        kept = scope.result(a.join(b, "id"))
    assert sorted(r.id for r in kept.collect()) == [0, 2, 4, 6, 8]
    discard(kept)
    discard(b)
    assert tables(spark) == before


def test_a_failing_scope_leaves_nothing(spark):
    before = tables(spark)
    with pytest.raises(Exception, match="HALF_WAY"):
        with scratch_scope(spark):
            materialize(spark.range(10), "a")
            materialize(spark.range(10).select(F.raise_error(F.lit("HALF_WAY")).alias("x")), "b")
    assert tables(spark) == before


@pytest.mark.parametrize("key", ["fit_quality", "model_roundtrip", "training_summary", "training_document", "stream_model_scored"])
def test_queries_leave_no_scratch_tables(spark, key):
    before = tables(spark)
    result = entry_mod.queries()[key](spark, SF_SMALL)
    read = {f.rsplit("/", 2)[1] for f in result.inputFiles()}
    left = {t.rsplit("-", 1)[0] for t in tables(spark) - before - read}
    # what a caller asked for stays: models, documents, messages and sinks
    assert left <= {"model", "event-model", "training", "messages", "stream-model"}


@pytest.mark.parametrize("key", ["csv_quarantine", "binned_areas", "sink_compacted", "missing_input"])
def test_query_matches_oracle(spark, key):
    import duckdb

    con = duckdb.connect()
    for t in ("lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cursor = con.execute(entry_mod.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    want = sorted(repr([None if isinstance(v, float) and math.isnan(v) else v for v in r]) for r in cursor.fetchall())
    rows = entry_mod.queries()[key](spark, SF_SMALL).select(*[f"`{n}`" for n in names]).collect()
    assert sorted(repr(list(r)) for r in rows) == want
